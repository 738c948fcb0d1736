"""The prediction history: assembly, appends, batch statistics, retrain signals, labels that arrive later."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import batch, feedback
from tidemark.operators.drift import mean_diff
from tidemark.operators.scaling import fit_scaler
from tidemark.operators.scoring import LinearModel, score
from tidemark.plans.catalogue.base import (
    CLASS_IDS,
    CUT,
    FEATURES,
    MODEL,
    labelled,
    lineitem,
    month,
    query,
    rnd,
    scored,
    scored_ctes,
    tidy,
)
from tidemark.plans.catalogue.drift import LINE_ROWS, MEANS
from tidemark.plans.catalogue.evaluation import WEIGHTED, class_ctes
from tidemark.sources import predictions as history
from tidemark.sources.tables import TableSpace, load_parquet
from tidemark.sources.workspace import fresh_folder

STATS = f"""{rnd("avg(prediction_probability)")} AS avg_confidence, {rnd("min(prediction_probability)")} AS min_confidence,
  {rnd("max(prediction_probability)")} AS max_confidence, count(*) FILTER (prediction_probability < 0.7e0) AS low_confidence_count,
  {rnd("count(*) FILTER (prediction_probability < 0.7e0) * 100.0e0 / count(*)")} AS low_confidence_pct, count(*) AS total_predictions,
  min(model_version) AS model_version"""


def stats_sql(source: str, by: str) -> str:
    """Batch statistics of ``source`` with the class distribution as text."""
    return f"""(SELECT b.*, d.class_distribution FROM (SELECT {by}, {STATS} FROM {source} GROUP BY {by}) b
JOIN (SELECT {by}, string_agg(predicted_class || ':' || n, ',' ORDER BY predicted_class) AS class_distribution
  FROM (SELECT {by}, predicted_class, count(*) AS n FROM {source} GROUP BY ALL) GROUP BY {by}) d USING ({by}))"""


def show_distribution(stats):
    pairs = F.transform(F.map_entries("class_distribution"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return tidy(stats.withColumn("class_distribution", F.array_join(pairs, ",")))


MONTHLY = f"{scored_ctes()}, monthly AS (SELECT *, strftime(l_shipdate, '%Y-%m') AS batch_id FROM scored)"


def monthly(spark, folder):
    return scored(spark, folder).withColumn("batch_id", month("l_shipdate"))


@query("batch_statistics", f"WITH {MONTHLY} SELECT * FROM {stats_sql('monthly', 'batch_id')}")
def batch_statistics(spark, folder):
    return show_distribution(batch.batch_statistics(monthly(spark, folder)))


@query(
    "batch_latest_only",
    f"WITH {MONTHLY}, one AS (SELECT * FROM monthly WHERE batch_id = '1997-05') SELECT * FROM {stats_sql('one', 'batch_id')}",
)
def batch_latest_only(spark, folder):
    return show_distribution(batch.batch_statistics(batch.batch_rows(monthly(spark, folder), "1997-05")))


STAMP = datetime(2024, 3, 5, 10, 30)


@query(
    "prediction_rows",
    f"""WITH {scored_ctes()} SELECT 'b-1' AS batch_id, '2024-03-05 10:30:00' AS prediction_timestamp, '2024-03-05' AS data_carga,
  model_version, 'production' AS model_alias, {", ".join(f"{rnd(f)} AS {f}" for f in FEATURES)}, predicted_class,
  {rnd("prediction_probability")} AS prediction_probability,
  {", ".join(f"{rnd(f'probability_class_{c}')} AS probability_class_{c}" for c in CLASS_IDS)} FROM scored""",
)
def prediction_rows(spark, folder):
    rows = batch.build_predictions(scored(spark, folder), FEATURES, CLASS_IDS, "b-1", STAMP)
    shown = {"prediction_timestamp": F.date_format("prediction_timestamp", "yyyy-MM-dd HH:mm:ss")}
    return tidy(rows.withColumns({**shown, "data_carga": F.col("data_carga").cast("string")}))


def fresh_space(spark, purpose: str) -> TableSpace:
    """An own schema below the shared folder for one run of a query."""
    place = fresh_folder(spark, purpose)
    name = f"tidemark_{place.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{place}/tables'")
    return TableSpace(spark, name)


@query(
    "history_append_read",
    f"""WITH {scored_ctes()}, halves AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 'first' ELSE 'second' END AS batch_id FROM scored)
SELECT *, CASE batch_id WHEN 'first' THEN '2024-03-04' ELSE '2024-03-05' END AS data_carga,
  batch_id = 'second' AS is_last FROM {stats_sql("halves", "batch_id")}""",
)
def history_append_read(spark, folder):
    """Two batches through the real sinks: typed partitioned history, batch pointer, statistics table."""
    space = fresh_space(spark, "history")
    rows, cut = labelled(spark, folder), F.lit(CUT).cast("timestamp_ntz")
    params = {r["feature"]: (r["mean"], r["scale"]) for r in fit_scaler(rows, FEATURES).collect()}
    history.create_predictions_table(space, FEATURES, CLASS_IDS)
    halves = (("first", 4, F.col("l_shipdate") < cut), ("second", 5, F.col("l_shipdate") >= cut))
    for batch_id, day, which in halves:
        made = datetime(2024, 3, day, 10, 30)
        part = score(rows.filter(which), MODEL, params)
        history.append_predictions(space, batch.build_predictions(part, FEATURES, CLASS_IDS, batch_id, made))
        history.write_pointer(space, batch_id, made)
        stored = batch.batch_rows(space.read(history.PREDICTIONS), batch_id, f"2024-03-{day:02d}")
        history.append_metadata(space, batch.batch_statistics(stored, ["batch_id", "data_carga"]), made)
    last = history.read_pointer(space)
    stats = space.read(history.METADATA).drop("recorded_at")
    stats = stats.withColumns({"data_carga": F.col("data_carga").cast("string"), "is_last": F.col("batch_id") == last})
    return show_distribution(stats)


@query(
    "retrain_trigger",
    f"""WITH {MONTHLY}, {MEANS.replace("ROWS_", LINE_ROWS)}, drift AS (SELECT max(abs(diff_pct)) AS shift FROM shifts),
s AS (SELECT * FROM {stats_sql("monthly", "batch_id")})
SELECT s.*, avg_confidence < 0.6e0 AS low_average, low_confidence_pct > 60.0e0 AS many_unsure, shift > 20.0e0 AS features_moved,
  avg_confidence < 0.6e0 OR low_confidence_pct > 60.0e0 OR shift > 20.0e0 AS retrain FROM s CROSS JOIN drift""",
)
def retrain_trigger(spark, folder):
    rows, cut = lineitem(spark, folder), F.lit(CUT).cast("timestamp_ntz")
    moved = mean_diff(rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut), FEATURES)
    shift = moved.agg(F.max(F.abs("diff_pct")).alias("max_abs_diff_pct"))
    stats = batch.batch_statistics(monthly(spark, folder))
    return show_distribution(batch.retrain_triggers(stats, shift, 0.6, 60.0))


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_MODEL = LinearModel(
    name="events",
    version=1,
    features=("value", "hour"),
    class_ids=(0, 1, 2, 3, 4),
    intercepts=(0.9, 0.4, 0.0, -0.3, 0.2),
    weights=((-0.01, 0.01), (0.002, 0.02), (0.012, 0.0), (0.004, 0.05), (0.001, 0.03)),
)
EVENT_KEY = (("event_id", "BIGINT"),)
FIRST_DAY = date(2024, 3, 1)


def _event_scores() -> str:
    """CTEs ending in ``s``: events with their class y, load day d (1 to 4) and predicted class p."""
    classes = " ".join(f"WHEN '{t}' THEN {c}" for c, t in enumerate(EVENT_TYPES))
    zs = ", ".join(
        f"{b!r}e0 + ({w[0]!r}e0) * value + ({w[1]!r}e0) * hour(ts) AS z{c}"
        for c, (b, w) in enumerate(zip(EVENT_MODEL.intercepts, EVENT_MODEL.weights))
    )
    best = "greatest(z0, z1, z2, z3, z4)"
    return f"""e AS (SELECT event_id, CASE event_type {classes} END AS y, 1 + event_id % 4 AS d, {zs} FROM events),
s AS (SELECT event_id, y, d, CASE {best} WHEN z0 THEN 0 WHEN z1 THEN 1 WHEN z2 THEN 2 WHEN z3 THEN 3 ELSE 4 END AS p FROM e)"""


def events(spark, folder):
    kind = F.array_position(F.array(*map(F.lit, EVENT_TYPES)), F.col("event_type")) - 1
    rows = load_parquet(spark, folder, "events")
    return rows.withColumns({"y": kind.cast("int"), "hour": F.hour("ts").cast("double"), "d": (1 + F.col("event_id") % 4).cast("int")})


def append_events(ledger, rows, day: int) -> None:
    """The predictions of one load date, as one batch."""
    made = datetime(2024, 3, day, 10, 30)
    scored_rows = score(rows.filter(F.col("d") == day), EVENT_MODEL)
    ledger.append(batch.build_predictions(scored_rows, EVENT_MODEL.features, EVENT_MODEL.class_ids, f"b{day}", made, key=["event_id"]), f"b{day}", made)


@query(
    "performance_from_history",
    f"""WITH {_event_scores()}, told AS (SELECT event_id, y AS label, 2 AS t FROM s WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, CASE WHEN event_id % 30 = 0 THEN (y + 1) % 5 ELSE y END, 5 FROM s WHERE event_id % 3 = 1 OR event_id % 30 = 0),
met AS (SELECT d, p, label, row_number() OVER (PARTITION BY event_id ORDER BY t DESC) AS place FROM s JOIN told USING (event_id) WHERE t - d BETWEEN -1 AND 3),
counts AS (SELECT d, label AS y, p, count(*) AS n FROM met WHERE place = 1 GROUP BY ALL), {class_ctes("d")},
m AS (SELECT d, {WEIGHTED} FROM classes GROUP BY d), days AS (SELECT d, count(*) AS n_predictions FROM s GROUP BY d)
SELECT '2024-03-0' || d AS data_carga, n_predictions, coalesce(total, 0)::BIGINT AS n_labelled, {rnd("coalesce(total, 0)::DOUBLE / n_predictions")} AS coverage,
  accuracy, precision, recall, f1_score FROM days LEFT JOIN m USING (d)""",
)
def performance_from_history(spark, folder):
    """Four daily batches with row keys; labels arrive in two batches, some never, some corrected; joined in three runs."""
    space = fresh_space(spark, "feedback")
    rows = events(spark, folder)
    preds = history.predictions_ledger(space, EVENT_MODEL.features, EVENT_MODEL.class_ids, EVENT_KEY)
    labels, outcomes = feedback.labels_ledger(space, EVENT_KEY), feedback.outcomes_ledger(space, EVENT_KEY)
    number = F.col("event_id")

    def tell(told, day: int) -> None:
        labels.append(told.select("event_id", F.col("y").alias("label"), F.lit(FIRST_DAY + timedelta(days=day - 1)).alias("labelled_on")), f"l{day}")

    def match() -> None:
        feedback.match_labels(preds, labels, outcomes, ["event_id"], horizon=3, early=1)

    append_events(preds, rows, 1)
    append_events(preds, rows, 2)
    tell(rows.filter(number % 3 == 0), 2)
    match()
    append_events(preds, rows, 3)
    append_events(preds, rows, 4)
    match()
    corrected = F.when(number % 30 == 0, (F.col("y") + 1) % 5).otherwise(F.col("y"))
    tell(rows.filter((number % 3 == 1) | (number % 30 == 0)).withColumn("y", corrected), 5)
    match()
    match()
    found = feedback.performance_by_day(preds, outcomes, ["event_id"])
    return tidy(found.withColumn("data_carga", F.col("data_carga").cast("string")))


@query(
    "history_manifest",
    f"""WITH {_event_scores()}, b AS (SELECT d, 'b' || d AS batch_id, count(*) AS n, sum(p) AS classes FROM s WHERE d <= 3 GROUP BY d)
SELECT batch_id, '2024-03-0' || d AS day, n, n AS n_read, classes::BIGINT AS classes, d = 3 AS is_last FROM b""",
)
def history_manifest(spark, folder):
    """Batches from the manifest beside what is read of them: one append was repeated, one stopped before it was published."""
    space = fresh_space(spark, "manifest")
    rows = events(spark, folder)
    preds = history.predictions_ledger(space, EVENT_MODEL.features, EVENT_MODEL.class_ids, EVENT_KEY)
    for day in (1, 2, 2, 3):
        append_events(preds, rows, day)
    left = score(rows.filter("d = 4"), EVENT_MODEL)
    preds.stage(batch.build_predictions(left, EVENT_MODEL.features, EVENT_MODEL.class_ids, "b4", datetime(2024, 3, 4), key=["event_id"]))
    last, _, _ = preds.last_batch()
    read = preds.read().groupBy("batch_id").agg(F.count("*").alias("n_read"), F.sum("predicted_class").alias("classes"))
    known = preds.published().filter("n > 0").join(read, "batch_id", "left")
    return known.select("batch_id", F.col("day").cast("string").alias("day"), "n", "n_read", "classes", (F.col("batch_id") == last).alias("is_last"))
