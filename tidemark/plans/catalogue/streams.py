"""Structured Streaming runs over the given files, read back as tables."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.batch import batch_statistics
from tidemark.operators.scaling import fit_scaler, scaler_values
from tidemark.plans.catalogue.base import CLASS_IDS, FEATURES, MODEL, lineitem, query, rnd, scored_ctes, tidy
from tidemark.plans.catalogue.history import fresh_space, show_distribution, stats_sql
from tidemark.sources import predictions as history
from tidemark.sources.tables import load_parquet
from tidemark.sources.workspace import fresh_folder
from tidemark.streaming.scores import (
    append_scored_batches,
    daily_stream_profile,
    score_stream,
    stream_parquet,
    write_stream,
)
from tidemark.streaming.windows import accounted_windows, write_windows


@query(
    "stream_scores",
    f"""WITH {scored_ctes()} SELECT l_orderkey, l_partkey, l_suppkey, predicted_class,
  {rnd("prediction_probability")} AS prediction_probability FROM scored""",
)
def stream_scores(spark, folder):
    params = scaler_values(fit_scaler(lineitem(spark, folder), FEATURES))
    rows = score_stream(stream_parquet(spark, folder, "lineitem"), MODEL, params)
    rows = rows.select("l_orderkey", "l_partkey", "l_suppkey", "predicted_class", "prediction_probability")
    place = fresh_folder(spark, "stream-scores")
    write_stream(rows, f"{place}/rows", f"{place}/state").awaitTermination()
    return tidy(spark.read.parquet(f"{place}/rows"))


@query(
    "stream_daily_window",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, {rnd("avg(value)")} AS avg_value FROM events
GROUP BY 1, 2, CAST(ts AS DATE) HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
)
def stream_daily_window(spark, folder):
    """Windows closed by the watermark; the last days stay open."""
    stream = stream_parquet(spark, folder, "events")
    place = fresh_folder(spark, "stream-daily")
    rows = daily_stream_profile(stream, "ts", ["event_type"], "value")
    write_stream(rows, f"{place}/rows", f"{place}/state").awaitTermination()
    found = spark.read.schema(rows.schema).parquet(f"{place}/rows")
    return tidy(found.withColumn("day", F.to_date("window_start").cast("string")).drop("window_start", "window_end"))


@query(
    "stream_history",
    f"""WITH {scored_ctes()}, one AS (SELECT *, '2024-03-06' AS data_carga FROM scored) SELECT * FROM {stats_sql("one", "data_carga")}""",
)
def stream_history(spark, folder):
    """Micro-batches appended to the prediction ledger, summarised by load date."""
    space = fresh_space(spark, "stream-history")
    ledger = history.predictions_ledger(space, FEATURES, CLASS_IDS)
    params = scaler_values(fit_scaler(lineitem(spark, folder), FEATURES))
    stream = stream_parquet(spark, folder, "lineitem")
    clock = lambda: datetime(2024, 3, 6, 12, 0)
    append_scored_batches(ledger, stream, MODEL, fresh_folder(spark, "state"), params, clock).awaitTermination()
    stored = ledger.read("2024-03-06", "2024-03-06").withColumn("data_carga", F.col("data_carga").cast("string"))
    return show_distribution(batch_statistics(stored, ["data_carga"]))


@query(
    "stream_windows_accounted",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, count(CASE WHEN event_id % 7 <> 0 THEN value END) AS known,
  {rnd("coalesce(sum(CASE WHEN event_id % 7 <> 0 THEN value END), 0)", 4)} AS total, true AS has_late FROM events
GROUP BY 1, 2, CAST(ts AS DATE) HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
)
def stream_windows_accounted(spark, folder):
    """Four files in turn, each with rows of all days: most rows come when their window has closed. Closed and late
    sums of a window together hold all its rows; every seventh value is NaN and counts in no mean."""
    place = fresh_folder(spark, "stream-windows")
    lines = load_parquet(spark, folder, "events")
    rows = lines.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    for turn in range(4):
        rows.filter(F.col("event_id") % 4 == turn).write.mode("append").parquet(f"{place}/events.parquet")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/events.parquet")
    windows = accounted_windows(stream, "ts", ["event_type"], "value")
    write_windows(windows, f"{place}/rows", f"{place}/state").awaitTermination()
    found = spark.read.schema(windows.schema).parquet(f"{place}/rows")
    sums = found.groupBy(F.to_date("window_start").cast("string").alias("day"), "event_type").agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("total").alias("total"), F.bool_or("late").alias("has_late")
    )
    return tidy(sums, 4)
