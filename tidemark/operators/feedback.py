"""Labels that arrive after the predictions: an incremental join of two ledgers, and metrics from what it found."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.evaluate import confusion_counts, weighted_metrics
from tidemark.sources.ledger import Ledger
from tidemark.sources.tables import TableSpace
from tidemark.sources.workspace import Summary

LABELS, OUTCOMES = "prediction_labels", "prediction_outcomes"
LABEL_DAY = "labelled_on"


def labels_ledger(space: TableSpace, key: Sequence[tuple[str, str]], table: str = LABELS) -> Ledger:
    """True classes by row key (name, type), with the day they arrived."""
    return Ledger(space, table, (*key, ("label", "INT"), (LABEL_DAY, "DATE")), LABEL_DAY).create()


def outcomes_ledger(space: TableSpace, key: Sequence[tuple[str, str]], table: str = OUTCOMES) -> Ledger:
    """Predictions that met a label, by the day of the prediction."""
    columns = (*key, ("batch_id", "STRING"), ("model_version", "INT"), ("predicted_class", "INT"), ("label", "INT"))
    return Ledger(space, table, (*columns, (LABEL_DAY, "DATE"), ("data_carga", "DATE"))).create()


def _range(manifest: DataFrame) -> tuple[date, date] | None:
    low, high = manifest.agg(F.min("day"), F.max("day")).first()
    return None if low is None else (low, high)


def match_labels(
    predictions: Ledger,
    labels: Ledger,
    outcomes: Ledger,
    key: Sequence[str],
    horizon: int = 30,
    early: int = 0,
    at: datetime | None = None,
) -> str | None:
    """Appends to ``outcomes`` what the batches published since the last run add to the join on ``key``.

    A label meets the predictions of its key made at most ``horizon`` days before it arrived, or ``early`` days
    after. New labels are joined with all predictions of those days, new predictions with all older labels of theirs;
    everything else was joined by an earlier run. The batches taken are published with the result: a run that stops
    is repeated from the same state, and no batch is skipped or taken twice, in whatever order they are published. One run
    at a time. Returns the id of the run, or None if there was nothing new.
    """
    done = Summary(outcomes.inputs()).rows
    new_ids, sides = [], {}
    for name, ledger in (("labels", labels), ("predictions", predictions)):
        # fixed now, so that what others publish meanwhile is left to the next run
        known = Summary(ledger.published().withColumn("input", F.concat(F.lit(f"{name}:"), "batch_id"))).rows
        new = Summary(known.join(done, "input", "left_anti")).rows
        sides[name] = known, new
        new_ids += sorted(r["input"] for r in new.select("input").distinct().collect())
    if not new_ids:
        return None
    (all_labels, new_labels), (all_predictions, new_predictions) = sides["labels"], sides["predictions"]
    old_labels = all_labels.join(new_labels.select("input").distinct(), "input", "left_anti")
    found = None
    before, after = timedelta(days=horizon), timedelta(days=early)
    if (span := _range(new_labels)) is not None:
        shown = predictions.read(span[0] - before, span[1] + after, all_predictions)
        found = _met(shown, labels.read(*span, new_labels), key, horizon, early)
    if (span := _range(new_predictions)) is not None:
        told = labels.read(span[0] - after, span[1] + before, old_labels)
        more = _met(predictions.read(*span, new_predictions), told, key, horizon, early)
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = predictions.space.spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in outcomes.columns))
    run_id = str(uuid.uuid5(uuid.NAMESPACE_URL, "|".join(new_ids)))
    outcomes.append(found, run_id, at, new_ids)
    return run_id


def _met(predictions: DataFrame, labels: DataFrame, key: Sequence[str], horizon: int, early: int) -> DataFrame:
    rows = predictions.select(*key, "batch_id", "model_version", "predicted_class", "data_carga")
    told = labels.select(*[F.col(k).alias(f"_{k}") for k in key], "label", LABEL_DAY)
    wait = F.datediff(LABEL_DAY, "data_carga")
    same = [F.col(k) == F.col(f"_{k}") for k in key]
    return rows.join(told, [*same, wait.between(-early, horizon)]).drop(*[f"_{k}" for k in key])


def latest_outcomes(outcomes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Of several labels of a prediction the last that arrived; of one day's, the largest."""
    last = F.max(F.struct(LABEL_DAY, "label")).alias("_last")
    rows = outcomes.groupBy(*key, "batch_id", "data_carga", "model_version", "predicted_class").agg(last)
    return rows.select("*", "_last.*").drop("_last")


def performance_by_day(
    predictions: Ledger, outcomes: Ledger, key: Sequence[str], since: date | str | None = None, until: date | str | None = None
) -> DataFrame:
    """Rows (data_carga, n_predictions, n_labelled, coverage, accuracy, precision, recall, f1_score) per day.

    Predictions are counted from the manifest; days without any label have no metrics.
    """
    days = predictions.days().filter(Ledger._between("day", since, until))
    judged = latest_outcomes(outcomes.read(since, until), key).filter("label IS NOT NULL")
    metrics = weighted_metrics(confusion_counts(judged, "label", "predicted_class", ["data_carga"]), ["data_carga"])
    rows = days.join(metrics, F.col("day") == F.col("data_carga"), "left")
    labelled = F.coalesce("total", F.lit(0).cast("bigint"))
    return rows.select(
        F.col("day").alias("data_carga"),
        F.col("n").alias("n_predictions"),
        labelled.alias("n_labelled"),
        (labelled / F.col("n")).alias("coverage"),
        "accuracy",
        "precision",
        "recall",
        "f1_score",
    )
