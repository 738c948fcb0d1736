"""Versions, aliases and promotion. The event table stands in for the log of many models."""

from pyspark.sql import functions as F

from tidemark.functions.columns import rounded
from tidemark.operators import registry
from tidemark.plans.catalogue.base import query, rnd, tidy
from tidemark.sources.tables import load_parquet

LOG_CTES = """log AS (SELECT 'm' || user_id AS model_name,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'production' WHEN event_type IN ('view', 'error') THEN 'challenger' ELSE 'baseline' END AS alias,
  CASE WHEN event_type IN ('signup', 'error') THEN 'DELETE' ELSE 'SET' END AS op,
  CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE CAST(event_id % 20 + 1 AS INTEGER) END AS version,
  event_id AS seq, ts FROM events),
versions AS (SELECT DISTINCT model_name, version FROM log WHERE op = 'SET'),
last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY model_name, alias ORDER BY seq DESC) = 1),
live AS (SELECT model_name, alias, version FROM last WHERE op = 'SET'),
tops AS (SELECT model_name, max(seq) AS top FROM log GROUP BY 1),
models AS (SELECT DISTINCT model_name FROM log),
accuracies AS (SELECT 'm' || user_id AS model_name, CAST(event_id % 20 + 1 AS INTEGER) AS version,
  floor(avg(value) / 500 * 1e3 + 0.5e0) / 1e3 AS accuracy FROM events GROUP BY 1, 2),
state AS (SELECT m.model_name, p.version AS pv, c.version AS cv FROM models m
  LEFT JOIN live p ON p.model_name = m.model_name AND p.alias = 'production'
  LEFT JOIN live c ON c.model_name = m.model_name AND c.alias = 'challenger'),
ab AS (SELECT s.model_name, pv, cv, a.accuracy AS pa, b.accuracy AS ca,
  CASE WHEN pv IS NULL THEN 'no_production' WHEN cv IS NULL THEN 'no_challenger' ELSE 'evaluated' END AS status FROM state s
  LEFT JOIN accuracies a ON a.model_name = s.model_name AND a.version = pv
  LEFT JOIN accuracies b ON b.model_name = s.model_name AND b.version = cv)"""


def log(spark, folder):
    kind = F.col("event_type")
    alias = F.when(kind.isin("purchase", "signup"), "production").when(kind.isin("view", "error"), "challenger")
    deletes = kind.isin("signup", "error")
    return load_parquet(spark, folder, "events").select(
        F.concat(F.lit("m"), "user_id").alias("model_name"),
        alias.otherwise("baseline").alias("alias"),
        F.when(deletes, "DELETE").otherwise("SET").alias("op"),
        F.when(~deletes, (F.col("event_id") % 20 + 1).cast("int")).alias("version"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def _versions(events):
    # kept as text, the way a registry returns them
    return events.filter("op = 'SET'").select("model_name", F.col("version").cast("string").alias("version")).distinct()


def _accuracies(spark, folder):
    events = load_parquet(spark, folder, "events")
    return events.groupBy(
        F.concat(F.lit("m"), "user_id").alias("model_name"), (F.col("event_id") % 20 + 1).cast("int").alias("version")
    ).agg(rounded(F.avg("value") / 500, 3).alias("accuracy"))


def _comparison(spark, folder):
    events = log(spark, folder)
    return registry.evaluate_ab(events.select("model_name").distinct(), events, _accuracies(spark, folder))


def _columns(events):
    return events.select("model_name", "alias", "op", "version", "seq")


@query("latest_version", f"WITH {LOG_CTES} SELECT model_name, max(version) AS latest_version FROM versions GROUP BY 1")
def latest_version(spark, folder):
    return registry.latest_versions(_versions(log(spark, folder)))


@query("alias_current", f"WITH {LOG_CTES} SELECT model_name, alias, version FROM live")
def alias_current(spark, folder):
    return registry.current_aliases(log(spark, folder))


@query(
    "alias_columns",
    f"""WITH {LOG_CTES} SELECT model_name, max(version) FILTER (alias = 'production') AS production_version,
  max(version) FILTER (alias = 'challenger') AS challenger_version FROM live GROUP BY 1""",
)
def alias_columns(spark, folder):
    return registry.alias_columns(log(spark, folder), ["production", "challenger"])


@query(
    "alias_set",
    f"""WITH {LOG_CTES} SELECT v.model_name, 'baseline' AS alias, 'SET' AS op, max(version) AS version, max(top) + 1 AS seq
FROM versions v JOIN tops USING (model_name) GROUP BY 1""",
)
def alias_set(spark, folder):
    events = log(spark, folder)
    requests = registry.latest_versions(_versions(events)).select(
        "model_name", F.lit("Baseline").alias("alias"), F.col("latest_version").alias("version")
    )
    return _columns(registry.set_alias(events, requests))


@query(
    "alias_delete",
    f"""WITH {LOG_CTES} SELECT model_name, alias, 'DELETE' AS op, CAST(NULL AS INTEGER) AS version, top + 1 AS seq
FROM live JOIN tops USING (model_name) WHERE alias = 'production'""",
)
def alias_delete(spark, folder):
    events = log(spark, folder)
    requests = events.select("model_name", F.lit("production").alias("alias")).distinct()
    return _columns(registry.delete_alias(events, requests))


@query(
    "alias_state_after_delete",
    f"WITH {LOG_CTES} SELECT model_name, alias, version FROM live WHERE alias <> 'production'",
)
def alias_state_after_delete(spark, folder):
    events = log(spark, folder)
    requests = events.select("model_name", F.lit("production").alias("alias")).distinct()
    return registry.current_aliases(events.unionByName(registry.delete_alias(events, requests)))


@query(
    "register_versions",
    f"""WITH {LOG_CTES} SELECT m.model_name, CAST(coalesce(max(v.version), 0) + 1 AS INTEGER) AS version,
  CASE WHEN bool_or(pv IS NOT NULL) THEN 'challenger' ELSE 'baseline' END AS alias, max(top) + 1 AS seq
FROM models m LEFT JOIN versions v USING (model_name) JOIN state USING (model_name) JOIN tops USING (model_name) GROUP BY 1""",
)
def register_versions(spark, folder):
    events = log(spark, folder)
    rows, aliases = registry.register(_versions(events), events, events.select("model_name").distinct())
    return rows.join(aliases.select("model_name", "alias", "seq"), "model_name").drop("created_at")


@query(
    "ab_evaluate",
    f"""WITH {LOG_CTES} SELECT model_name, status, CASE WHEN status = 'evaluated' THEN pv END AS production_version,
  CASE WHEN status = 'evaluated' THEN cv END AS challenger_version,
  {rnd("CASE WHEN status = 'evaluated' THEN pa END")} AS production_accuracy,
  {rnd("CASE WHEN status = 'evaluated' THEN ca END")} AS challenger_accuracy,
  CASE WHEN status = 'evaluated' THEN CASE WHEN ca > pa THEN 'challenger' ELSE 'production' END END AS winner,
  {rnd("CASE WHEN status = 'evaluated' THEN ca - pa END")} AS improvement,
  CASE WHEN status = 'evaluated' THEN ca > pa END AS should_promote,
  CASE WHEN status = 'no_production' THEN 'Nenhum modelo production encontrado para comparação'
    WHEN status = 'no_challenger' THEN 'Nenhum modelo challenger encontrado para comparação'
    WHEN ca > pa THEN printf('challenger venceu com %.4f de melhoria em accuracy', ca - pa)
    ELSE 'production permanece. challenger não superou o modelo atual.' END AS message FROM ab""",
)
def ab_evaluate(spark, folder):
    return tidy(_comparison(spark, folder))


@query(
    "alias_promote",
    f"""WITH {LOG_CTES}, won AS (SELECT model_name, cv, top FROM ab JOIN tops USING (model_name) WHERE status = 'evaluated' AND ca > pa)
SELECT model_name, 'production' AS alias, 'SET' AS op, cv AS version, top + 1 AS seq FROM won
UNION ALL SELECT model_name, 'challenger', 'DELETE', NULL, top + 2 FROM won""",
)
def alias_promote(spark, folder):
    return _columns(registry.promote(log(spark, folder), _comparison(spark, folder)))


@query(
    "alias_promote_baseline",
    f"""WITH {LOG_CTES}, won AS (SELECT model_name, version, top FROM live JOIN tops USING (model_name) WHERE alias = 'baseline')
SELECT model_name, 'production' AS alias, 'SET' AS op, version, top + 1 AS seq FROM won
UNION ALL SELECT model_name, 'baseline', 'DELETE', NULL, top + 2 FROM won""",
)
def alias_promote_baseline(spark, folder):
    events = log(spark, folder)
    return _columns(registry.promote(events, events.select("model_name").distinct(), from_alias="baseline"))


@query(
    "alias_discard",
    f"""WITH {LOG_CTES} SELECT model_name, 'challenger' AS alias, 'DELETE' AS op, CAST(NULL AS INTEGER) AS version, top + 1 AS seq
FROM ab JOIN tops USING (model_name) WHERE status = 'evaluated' AND NOT coalesce(ca > pa, false)""",
)
def alias_discard(spark, folder):
    return _columns(registry.discard_losers(log(spark, folder), _comparison(spark, folder)))


@query(
    "alias_rollback",
    f"""WITH {LOG_CTES} SELECT v.model_name, 'production' AS alias, 'SET' AS op, min(v.version) AS version, max(top) + 1 AS seq
FROM versions v JOIN tops USING (model_name) GROUP BY 1""",
)
def alias_rollback(spark, folder):
    events = log(spark, folder)
    versions = _versions(events)
    oldest = versions.groupBy("model_name").agg(F.min(F.col("version").cast("int")).alias("version"))
    return _columns(registry.rollback(events, oldest, versions))


@query(
    "alias_intervals",
    f"""WITH {LOG_CTES}, s AS (SELECT model_name, version, ts, lead(ts) OVER (PARTITION BY model_name ORDER BY ts) AS until
  FROM log WHERE alias = 'production')
SELECT model_name, version, epoch_us(ts) AS from_us, epoch_us(until) AS to_us FROM s WHERE version IS NOT NULL""",
)
def alias_intervals(spark, folder):
    spans = registry.alias_intervals(log(spark, folder))
    times = {"from_us": F.unix_micros("valid_from"), "to_us": F.unix_micros("valid_to")}
    return spans.withColumns(times).drop("valid_from", "valid_to")


ASOF_SQL = f"""WITH {LOG_CTES}, preds AS (SELECT event_id, 'm' || user_id AS model_name, ts + INTERVAL 3 HOUR AS at FROM events)
SELECT p.event_id, p.model_name, c.version AS version_asof FROM preds p
ASOF LEFT JOIN (SELECT * FROM log WHERE alias = 'production') c ON p.model_name = c.model_name AND p.at >= c.ts"""


def _predictions(spark, folder):
    return load_parquet(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("m"), "user_id").alias("model_name"),
        (F.col("ts").cast("timestamp") + F.expr("INTERVAL 3 HOURS")).alias("at"),
    )


@query("asof_model_version", ASOF_SQL)
def asof_model_version(spark, folder):
    return registry.production_version_asof(_predictions(spark, folder), log(spark, folder), "at").drop("at")


@query("asof_model_version_cells", ASOF_SQL)
def asof_model_version_cells(spark, folder):
    preds = _predictions(spark, folder)
    return registry.production_version_asof(preds, log(spark, folder), "at", broadcast_rows=0).drop("at")
