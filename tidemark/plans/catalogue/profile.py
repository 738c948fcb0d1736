"""Profiles of tables and of prediction history."""

from pyspark.sql import functions as F

from tidemark.operators import profile, sketches
from tidemark.plans.catalogue.base import (
    CUT,
    FEATURES,
    lineitem,
    long_sql,
    month,
    query,
    rnd,
    scored,
    scored_ctes,
    tidy,
)
from tidemark.sources.tables import load_parquet
from tidemark.sources.workspace import durable, fresh_folder

# four digits: prices sum to values whose last digits depend on the order of addition
NUMBERS = f"""{rnd("avg(v)", 4)} AS mean, {rnd("stddev_samp(v)", 4)} AS std, {rnd("min(v)", 4)} AS min, {rnd("max(v)", 4)} AS max"""
QUARTILES = f"""{rnd("quantile_cont(v, 0.25e0)", 4)} AS p25, {rnd("median(v)", 4)} AS p50, {rnd("quantile_cont(v, 0.75e0)", 4)} AS p75"""


@query(
    "numeric_describe",
    f"""SELECT feature, count(v) AS count, {NUMBERS}, {QUARTILES}
FROM ({long_sql(("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *FEATURES))}) GROUP BY feature""",
)
def numeric_describe(spark, folder):
    return tidy(profile.describe_numeric(lineitem(spark, folder)), 4)


@query(
    "numeric_describe_cells",
    f"""SELECT l_returnflag, feature, count(v) AS count, {NUMBERS}, {QUARTILES}
FROM ({long_sql(FEATURES, "l_returnflag")}) GROUP BY l_returnflag, feature""",
)
def numeric_describe_cells(spark, folder):
    return tidy(profile.describe_numeric(lineitem(spark, folder), FEATURES, ["l_returnflag"]), 4)


@query(
    "distribution_stats",
    f"""SELECT l_linestatus, feature, {NUMBERS}, {rnd("median(v)", 4)} AS median
FROM ({long_sql(FEATURES, "l_linestatus")}) GROUP BY l_linestatus, feature""",
)
def distribution_stats(spark, folder):
    return tidy(profile.distribution_stats(lineitem(spark, folder), FEATURES, ["l_linestatus"]), 4)


EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


@query(
    "non_null_info",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) AS "rows" FROM events"""
        for c, t in EVENT_TYPES.items()
    ),
)
def non_null_info(spark, folder):
    return profile.non_null_info(load_parquet(spark, folder, "events"))


@query(
    "value_counts_pct",
    f"""SELECT o_orderpriority, count(*) AS count, {rnd("count(*) * 100.0e0 / sum(count(*)) OVER ()")} AS pct
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority""",
)
def value_counts_pct(spark, folder):
    return tidy(profile.value_counts(load_parquet(spark, folder, "orders"), "o_orderpriority", pct=True))


@query(
    "sorted_classes",
    f"WITH {scored_ctes()} SELECT predicted_class, count(*) AS count FROM scored GROUP BY predicted_class ORDER BY 1",
)
def sorted_classes(spark, folder):
    return profile.sorted_classes(scored(spark, folder), "predicted_class")


@query(
    "daily_feature_mean",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS data_carga, {rnd("avg(value)")} AS avg_value,
  {rnd("avg(user_id)")} AS avg_user_id FROM events GROUP BY 1""",
)
def daily_feature_mean(spark, folder):
    events = load_parquet(spark, folder, "events")
    return tidy(profile.feature_means_by_date(events, F.to_date("ts").cast("string"), ["value", "user_id"]))


@query(
    "daily_volume_rollup",
    f"""WITH {scored_ctes()}
SELECT strftime(l_shipdate, '%Y-%m') AS month, predicted_class, model_version, count(*) AS predictions,
  CAST(grouping(strftime(l_shipdate, '%Y-%m'), predicted_class, model_version) AS BIGINT) AS level
FROM scored GROUP BY ROLLUP (strftime(l_shipdate, '%Y-%m'), predicted_class, model_version)""",
)
def daily_volume_rollup(spark, folder):
    rows = scored(spark, folder).withColumn("month", month("l_shipdate"))
    return profile.prediction_volume(rows, ["month", "predicted_class", "model_version"])


@query(
    "confidence_histogram",
    f"""WITH {scored_ctes()}, b AS (SELECT least(CAST(floor(prediction_probability * 10) AS INTEGER), 9) AS bin FROM scored)
SELECT bin, {rnd("bin / 10.0e0")} AS low, {rnd("(bin + 1) / 10.0e0")} AS high, count(*) AS count FROM b GROUP BY bin""",
)
def confidence_histogram(spark, folder):
    return tidy(profile.confidence_histogram(scored(spark, folder)))


@query(
    "low_confidence_rows",
    f"""WITH {scored_ctes()}
SELECT l_orderkey, l_partkey, l_suppkey, predicted_class, {rnd("prediction_probability")} AS prediction_probability
FROM scored WHERE prediction_probability < 0.4e0""",
)
def low_confidence_rows(spark, folder):
    rows = profile.low_confidence(scored(spark, folder), limit=0.4)
    return tidy(rows.select("l_orderkey", "l_partkey", "l_suppkey", "predicted_class", "prediction_probability"))


@query(
    "low_confidence_by_month",
    f"""WITH {scored_ctes()}
SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) FILTER (prediction_probability < 0.7e0) AS low_confidence_count,
  count(*) AS total, {rnd("count(*) FILTER (prediction_probability < 0.7e0) * 100.0e0 / count(*)")} AS low_confidence_pct
FROM scored GROUP BY 1""",
)
def low_confidence_by_month(spark, folder):
    rows = scored(spark, folder).withColumn("month", month("l_shipdate"))
    return tidy(profile.low_confidence_rate(rows, ["month"]))


@query(
    "daily_slice_profile",
    f"""WITH base AS (SELECT event_type, avg(value) AS baseline_mean FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1)
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, e.event_type, 'value' AS feature, count(value) AS count,
  {rnd("avg(value)")} AS mean, {rnd("stddev_samp(value)")} AS std, {rnd("min(value)")} AS min, {rnd("max(value)")} AS max,
  {rnd("median(value)")} AS median, {rnd("any_value(baseline_mean)")} AS baseline_mean
FROM events e LEFT JOIN base b ON e.event_type = b.event_type GROUP BY 1, 2""",
)
def daily_slice_profile(spark, folder):
    events = load_parquet(spark, folder, "events")
    baseline = events.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    stats = profile.slice_profile(events, "ts", ["value"], ["event_type"], baseline=baseline)
    return tidy(stats.withColumn("day", F.to_date("window_start").cast("string")).drop("window_start"))


@query(
    "profile_two_sides",
    f"""SELECT side, feature, {NUMBERS}, {rnd("median(v)", 4)} AS median FROM (
{long_sql(FEATURES, f"CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 'baseline' ELSE 'production' END AS side")})
GROUP BY side, feature""",
)
def profile_two_sides(spark, folder):
    rows, cut = lineitem(spark, folder), F.lit(CUT).cast("timestamp_ntz")
    sides = rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut)
    return tidy(profile.compare_profiles(*sides, FEATURES), 4)


@query(
    "preview_rows",
    "SELECT event_id, user_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 5",
)
def preview_rows(spark, folder):
    events = load_parquet(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return profile.preview(events, [F.desc("value"), "event_id"])


WEEKS = "CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR)"


@query(
    "weekly_profile_from_sketches",
    f"""SELECT {WEEKS} AS week, event_type, count(*) AS count, {rnd("sum(value)", 4)} AS total, {rnd("stddev_samp(value)", 4)} AS std,
  min(value) AS min, max(value) AS max, 3 AS quantiles, true AS within_bound FROM events GROUP BY 1, 2""",
)
def weekly_profile_from_sketches(spark, folder):
    """Daily sketches by event type, stored, rolled up to weeks; ranks of the estimates counted over all rows."""
    events = load_parquet(spark, folder, "events")
    place = fresh_folder(spark, "sketches")
    sketches.sketch_table(events, F.to_date("ts"), ["value"], ["event_type"]).write.parquet(place)
    weekly = {"week": F.to_date(F.date_trunc("week", "day")).cast("string"), "event_type": F.col("event_type")}
    profile_rows = sketches.read_profile(sketches.roll_up(spark.read.parquet(place), weekly), list(weekly))
    profile_rows = durable(profile_rows)
    by = {"week": F.to_date(F.date_trunc("week", F.to_date("ts"))).cast("string"), "event_type": F.col("event_type")}
    errors = sketches.rank_errors(events, profile_rows, "value", by)
    # the published bound is one quantile's at 99 %; twice that is left by fewer than one of a million
    judged = errors.groupBy(*by).agg(F.count("*").cast("int").alias("quantiles"), F.bool_and(F.col("rank_error") <= 2 * sketches.rank_bound()).alias("within_bound"))
    shown = tidy(profile_rows.select(*by, "count", (F.col("mean") * F.col("count")).alias("total"), "std", "min", "max"), 4)
    return shown.join(judged, list(by))
