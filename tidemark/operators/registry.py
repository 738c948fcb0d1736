"""Model versions, aliases and promotion as append-only tables, for all models at once.

``versions``: rows ``(model_name, version[, ...])``.
``log``: alias events ``(model_name, alias, op, version, seq[, ts])``; ``op`` is ``SET`` or
``DELETE`` and ``seq`` orders the events of a model. State is always the latest event, found with a
map-side combined aggregate, so a model holding most of the log does not fill one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import cell_grid, to_cells
from tidemark.operators.scoring import LinearModel
from tidemark.sources.workspace import Summary

ALIAS_LOG = "model_name string, alias string, op string, version int, seq bigint, ts timestamp"
VERSIONS = "model_name string, version int, created_at timestamp"
METRIC_LOG = "run_id string, model_name string, version int, metric string, value double"
PARAM_LOG = "run_id string, model_name string, version int, param string, value string"
EVENT = ["model_name", "alias", "op", "version", "seq", "ts"]


def latest_versions(versions: DataFrame) -> DataFrame:
    """Rows ``(model_name, latest_version)``; versions compare as numbers, so 10 beats 9."""
    return versions.groupBy("model_name").agg(F.max(F.col("version").cast("int")).alias("latest_version"))


def last_events(log: DataFrame) -> DataFrame:
    """The latest event per model and alias, deletes included."""
    last = log.groupBy("model_name", F.lower("alias").alias("alias")).agg(
        F.max(F.struct("seq", "op", F.col("version").cast("int").alias("version"))).alias("e")
    )
    return last.select("model_name", "alias", "e.op", "e.version", "e.seq")


def current_aliases(log: DataFrame) -> DataFrame:
    """Rows ``(model_name, alias, version)`` of the live aliases."""
    return last_events(log).filter(F.col("op") == "SET").select("model_name", "alias", "version")


def version_by_alias(log: DataFrame, model_name: str, alias: str) -> int | None:
    """The version an alias points at, or None."""
    row = (
        current_aliases(log.filter(F.col("model_name") == model_name)).filter(F.col("alias") == alias.lower()).first()
    )
    return None if row is None else row["version"]


def model_by_alias(coefficients: DataFrame, log: DataFrame, model_name: str, alias: str) -> LinearModel:
    """The model an alias points at; ValueError when the alias is not set."""
    version = version_by_alias(log, model_name, alias)
    if version is None:
        raise ValueError(f"model {model_name} has no alias '{alias}'")
    return LinearModel.from_table(coefficients, model_name, version)


def _events(log: DataFrame, requests: DataFrame, op: str, ts: Column) -> DataFrame:
    """Requests ``(model_name, alias, version[, ord])`` as events following each model's last one."""
    twice = requests.groupBy("model_name", F.lower("alias").alias("alias")).count().filter("count > 1")
    if "ord" not in requests.columns:
        if not twice.isEmpty():
            raise ValueError("several requests for one alias: give their order in a column 'ord'")
        requests = requests.withColumn("ord", F.row_number().over(Window.partitionBy("model_name").orderBy(F.lower("alias"))))
    last = log.groupBy(F.col("model_name").alias("_m")).agg(F.max("seq").alias("_seq"))
    return requests.join(last, F.col("model_name") == F.col("_m"), "left").select(
        "model_name",
        F.lower("alias").alias("alias"),
        F.lit(op).alias("op"),
        F.col("version").cast("int").alias("version"),
        (F.coalesce("_seq", F.lit(0)) + F.col("ord")).cast("bigint").alias("seq"),
        ts.cast("timestamp").alias("ts"),
    )


def set_alias(log: DataFrame, requests: DataFrame, ts: Column | None = None) -> DataFrame:
    """New SET events for ``(model_name, alias, version)`` requests; setting a used alias moves it."""
    return _events(log, requests, "SET", F.lit(None) if ts is None else ts)


def delete_alias(log: DataFrame, requests: DataFrame, ts: Column | None = None) -> DataFrame:
    """New DELETE events for ``(model_name, alias)`` requests; none where the alias is not live."""
    live = current_aliases(log).select(F.col("model_name").alias("_lm"), F.col("alias").alias("_la"))
    alive = requests.join(
        live, (F.col("model_name") == F.col("_lm")) & (F.lower("alias") == F.col("_la")), "left_semi"
    )
    return _events(log, alive.withColumn("version", F.lit(None).cast("int")), "DELETE", F.lit(None) if ts is None else ts)


def alias_columns(log: DataFrame, aliases: Sequence[str]) -> DataFrame:
    """One row per model with the version behind each alias, as ``{alias}_version`` (NULL if not set)."""
    live = current_aliases(log)
    return live.groupBy("model_name").agg(
        *[F.max(F.when(F.col("alias") == a, F.col("version"))).alias(f"{a}_version") for a in aliases]
    )


def register(
    versions: DataFrame, log: DataFrame, models: DataFrame, ts: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """New version rows and alias events for ``models`` (rows ``(model_name)``).

    The version follows the greatest one; the alias is ``challenger`` where a production version
    exists and ``baseline`` otherwise.
    """
    at = F.lit(None) if ts is None else ts
    last = latest_versions(versions).select(F.col("model_name").alias("_m"), "latest_version")
    state = alias_columns(log, ["production"]).select(F.col("model_name").alias("_a"), "production_version")
    fresh = (
        models.select("model_name")
        .join(last, F.col("model_name") == F.col("_m"), "left")
        .join(state, F.col("model_name") == F.col("_a"), "left")
        .select(
            "model_name",
            (F.coalesce("latest_version", F.lit(0)) + 1).cast("int").alias("version"),
            F.when(F.col("production_version").isNotNull(), F.lit("challenger")).otherwise(F.lit("baseline")).alias("alias"),
        )
    )
    rows = fresh.select("model_name", "version", at.cast("timestamp").alias("created_at"))
    return rows, set_alias(log, fresh, ts)


def evaluate_ab(models: DataFrame, log: DataFrame, accuracies: DataFrame) -> DataFrame:
    """Challenger against production for every model.

    ``models``: rows ``(model_name)``; ``accuracies``: rows ``(model_name, version, accuracy)``.
    A missing production is reported before a missing challenger; only a strictly greater accuracy
    is worth promoting.
    """
    state = alias_columns(log, ["production", "challenger"]).withColumnRenamed("model_name", "_m")
    rows = models.select("model_name").join(state, F.col("model_name") == F.col("_m"), "left").drop("_m")
    for side in ("production", "challenger"):
        metric = accuracies.select(
            F.col("model_name").alias("_m"), F.col("version").alias("_v"), F.col("accuracy").alias(f"{side}_accuracy")
        )
        match = (F.col("model_name") == F.col("_m")) & (F.col(f"{side}_version") == F.col("_v"))
        rows = rows.join(metric, match, "left").drop("_m", "_v")
    status = (
        F.when(F.col("production_version").isNull(), F.lit("no_production"))
        .when(F.col("challenger_version").isNull(), F.lit("no_challenger"))
        .otherwise(F.lit("evaluated"))
    )
    evaluated = F.col("status") == "evaluated"
    better = F.coalesce(F.col("challenger_accuracy") > F.col("production_accuracy"), F.lit(False))
    rows = rows.withColumn("status", status)
    # an unevaluated pair carries no figures
    for c in ("production_version", "challenger_version", "production_accuracy", "challenger_accuracy"):
        rows = rows.withColumn(c, F.when(evaluated, F.col(c)))
    rows = rows.withColumns(
        {
            "winner": F.when(evaluated, F.when(better, F.lit("challenger")).otherwise(F.lit("production"))),
            "improvement": F.col("challenger_accuracy") - F.col("production_accuracy"),
            "should_promote": F.when(evaluated, better),
        }
    )
    # fixed message formats
    message = (
        F.when(F.col("status") == "no_production", F.lit("Nenhum modelo production encontrado para comparação"))
        .when(F.col("status") == "no_challenger", F.lit("Nenhum modelo challenger encontrado para comparação"))
        .when(
            F.col("should_promote"),
            F.format_string("challenger venceu com %.4f de melhoria em accuracy", F.col("improvement")),
        )
        .otherwise(F.lit("production permanece. challenger não superou o modelo atual."))
    )
    return rows.withColumn("message", message)


def promote(
    log: DataFrame,
    models: DataFrame,
    from_alias: str = "challenger",
    to_alias: str = "production",
    ts: Column | None = None,
) -> DataFrame:
    """Events that move ``to_alias`` to the version behind ``from_alias`` and drop ``from_alias``.

    ``models``: rows ``(model_name[, should_promote])``; models without ``from_alias``, or with
    ``should_promote`` not true, yield no event.
    """
    chosen = models.filter("coalesce(should_promote, false)") if "should_promote" in models.columns else models
    live = current_aliases(log).filter(F.col("alias") == from_alias.lower())
    ready = live.join(chosen.select("model_name").distinct(), "model_name", "left_semi")
    moved = set_alias(log, ready.select("model_name", F.lit(to_alias).alias("alias"), "version"), ts)
    dropped = _events(
        log,
        ready.select(
            "model_name", F.lit(from_alias).alias("alias"), F.lit(None).cast("int").alias("version"), F.lit(2).alias("ord")
        ),
        "DELETE",
        F.lit(None) if ts is None else ts,
    )
    return moved.unionByName(dropped)


def rollback(log: DataFrame, targets: DataFrame, versions: DataFrame, ts: Column | None = None) -> DataFrame:
    """Events that point ``production`` at an older registered version: ``(model_name, version)``."""
    known = versions.select("model_name", F.col("version").cast("int").alias("version"))
    wanted = targets.select("model_name", F.col("version").cast("int").alias("version"))
    valid = wanted.join(known, ["model_name", "version"], "left_semi")
    return set_alias(log, valid.withColumn("alias", F.lit("production")), ts)


def discard_losers(log: DataFrame, comparison: DataFrame, ts: Column | None = None) -> DataFrame:
    """Events that drop the challenger of every model whose comparison says not to promote."""
    losers = comparison.filter((F.col("status") == "evaluated") & ~F.col("should_promote"))
    return delete_alias(log, losers.select("model_name", F.lit("challenger").alias("alias")), ts)


def alias_intervals(log: DataFrame, alias: str = "production", ts: str = "ts") -> DataFrame:
    """Rows ``(model_name, version, valid_from, valid_to)``; ``valid_to`` is exclusive, NULL if open.

    Meant for logs of operational size: one window per model.
    """
    changes = _changes(log, alias, ts)
    window = Window.partitionBy("model_name").orderBy("valid_from")
    spans = changes.withColumn("valid_to", F.lead("valid_from").over(window))
    return spans.filter(F.col("version").isNotNull()).select("model_name", "version", "valid_from", "valid_to")


def _changes(log: DataFrame, alias: str, ts: str) -> DataFrame:
    """One state change per model and instant: the last event counts; a delete is a NULL version."""
    version = F.when(F.col("op") == "SET", F.col("version").cast("int"))
    return (
        log.filter((F.lower("alias") == alias.lower()) & F.col(ts).isNotNull())
        .groupBy("model_name", F.col(ts).alias("valid_from"))
        .agg(F.max(F.struct("seq", version.alias("version"))).alias("e"))
        .select("model_name", "valid_from", "e.version")
    )


def production_version_asof(
    preds: DataFrame,
    log: DataFrame,
    ts: str,
    alias: str = "production",
    log_ts: str = "ts",
    broadcast_rows: int = 100_000,
    spans_per_model: int = 100,
) -> DataFrame:
    """Adds ``version_asof``: the version behind ``alias`` when each row was made (NULL if none).

    A log proven small, with few changes per model, is broadcast as validity intervals. Otherwise the
    distinct (model, time) pairs are resolved inside ordered time cells, each starting from the state
    carried in from earlier cells, and joined back; no task ever holds a whole model and no row is
    held against all changes of its model.
    """
    changes = Summary(_changes(log, alias, log_ts), limit=broadcast_rows)
    if changes.small and changes.rows.groupBy("model_name").count().filter(F.col("count") > spans_per_model).isEmpty():
        window = Window.partitionBy("model_name").orderBy("valid_from")
        spans = changes.rows.withColumn("_to", F.lead("valid_from").over(window)).select(
            F.col("model_name").alias("_m"),
            F.col("valid_from").alias("_from"),
            "_to",
            F.col("version").alias("version_asof"),
        )
        match = (
            (F.col("model_name") == F.col("_m"))
            & (F.col(ts) >= F.col("_from"))
            & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
        )
        return preds.join(F.broadcast(spans), match, "left").drop("_m", "_from", "_to")
    asked = preds.filter(F.col(ts).isNotNull()).select("model_name", F.col(ts).alias("at")).distinct()
    points = asked.select("model_name", "at", F.lit(1).alias("ask"), F.lit(None).cast("int").alias("version")).unionByName(
        changes.rows.select("model_name", F.col("valid_from").alias("at"), F.lit(0).alias("ask"), "version")
    )
    points = points.withColumn("_micros", F.unix_micros(F.col("at").cast("timestamp")).cast("double"))
    cells = to_cells(points, cell_grid(points, ["_micros"]), ["model_name", "at", "ask", "version"])
    state = F.struct("at", "version")
    closing = cells.groupBy("model_name", "cell").agg(F.max(F.when(F.col("ask") == 0, state)).alias("last"))
    earlier = Window.partitionBy("model_name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = closing.select(
        F.col("model_name").alias("_m"), F.col("cell").alias("_c"), F.max("last").over(earlier).alias("carry")
    )
    inside = Window.partitionBy("model_name", "cell").orderBy("at", "ask").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.max(F.when(F.col("ask") == 0, state)).over(inside)
    resolved = (
        cells.join(carried, (F.col("model_name") == F.col("_m")) & (F.col("cell") == F.col("_c")))
        .withColumn("version_asof", F.coalesce(latest, F.col("carry"))["version"])
        .filter(F.col("ask") == 1)
        .select(F.col("model_name").alias("_rm"), F.col("at").alias("_at"), "version_asof")
    )
    match = (F.col("model_name") == F.col("_rm")) & (F.col(ts) == F.col("_at"))
    return preds.join(resolved, match, "left").drop("_rm", "_at")


def metric_rows(metrics: DataFrame, run_id: str, model_name: str, version: int) -> DataFrame:
    """Long metrics ``(metric, value)`` as rows of the metric log."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(model_name).alias("model_name"),
        F.lit(version).cast("int").alias("version"),
        "metric",
        F.col("value").cast("double").alias("value"),
    )


def param_rows(spark: SparkSession, params: Mapping[str, object], run_id: str, model_name: str, version: int) -> DataFrame:
    """The settings of a run as rows of the parameter log, by name; values are kept as text, None as NULL."""
    rows = [(run_id, model_name, version, name, None if value is None else str(value)) for name, value in sorted(params.items())]
    return spark.createDataFrame(rows, PARAM_LOG)
