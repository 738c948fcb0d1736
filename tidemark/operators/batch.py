"""Assembly of the prediction history and statistics per batch."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_double, ratio
from tidemark.operators.profile import LOW_CONFIDENCE


def new_batch_id() -> str:
    """One identifier per batch, drawn once on the driver."""
    return str(uuid.uuid4())


def build_predictions(
    scored: DataFrame,
    features: Sequence[str],
    class_ids: Sequence[int],
    batch_id: str,
    ts: datetime,
    alias: str = "production",
    key: Sequence[str] = (),
) -> DataFrame:
    """Scored rows in the fixed column order of the history table; one ``ts`` stamps the batch.

    ``key`` names columns that tell rows apart: they come first, and labels that arrive later are joined by them.
    """
    stamp = F.lit(ts).cast("timestamp")
    return scored.select(
        *key,
        F.lit(batch_id).alias("batch_id"),
        stamp.alias("prediction_timestamp"),
        F.to_date(stamp).alias("data_carga"),
        F.col("model_version").cast("int").alias("model_version"),
        F.lit(alias).alias("model_alias"),
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col("predicted_class").cast("int").alias("predicted_class"),
        F.col("prediction_probability").cast("double").alias("prediction_probability"),
        *[F.col(f"probability_class_{c}").cast("double").alias(f"probability_class_{c}") for c in class_ids],
    )


def batch_rows(preds: DataFrame, batch_id: str, day: str | None = None) -> DataFrame:
    """Rows of one batch; the load date, when known, prunes partitions."""
    rows = preds.filter(F.col("batch_id") == F.lit(batch_id))
    return rows if day is None else rows.filter(F.col("data_carga") == F.lit(day).cast("date"))


def rows_of_day(preds: DataFrame, day: str | None = None) -> DataFrame:
    """Rows loaded on ``day`` (today by default)."""
    return preds.filter(F.col("data_carga") == (F.current_date() if day is None else F.lit(day).cast("date")))


def batch_statistics(preds: DataFrame, by: Sequence[str] = ("batch_id",), limit: float = LOW_CONFIDENCE) -> DataFrame:
    """One row per batch, for all batches at once.

    ``class_distribution`` maps class to count (NULL class left out); the low-confidence share is
    over all rows. The rows are shuffled once, already combined per batch and class.
    """
    by = list(by)
    confidence = clean_double("prediction_probability")
    per_class = preds.groupBy(*by, F.col("predicted_class").cast("int").alias("class")).agg(
        F.count("*").alias("n"),
        F.sum(confidence).alias("total"),
        F.count(confidence).alias("known"),
        F.min(confidence).alias("low"),
        F.max(confidence).alias("high"),
        F.count_if(confidence < limit).alias("unsure"),
        F.min("model_version").alias("model_version"),
    )
    entry = F.when(F.col("class").isNotNull(), F.struct("class", "n"))
    unsure = F.sum("unsure")
    return per_class.groupBy(*by).agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("class_distribution"),
        ratio(F.sum("total"), F.sum("known")).alias("avg_confidence"),
        F.min("low").alias("min_confidence"),
        F.max("high").alias("max_confidence"),
        unsure.alias("low_confidence_count"),
        (ratio(unsure, F.sum("n")) * 100).alias("low_confidence_pct"),
        F.sum("n").alias("total_predictions"),
        F.min("model_version").cast("int").alias("model_version"),
    )


def retrain_triggers(
    stats: DataFrame,
    max_abs_diff_pct: DataFrame | float | None = None,
    min_avg_confidence: float = 0.75,
    max_low_confidence_pct: float = 15.0,
    max_feature_drift_pct: float = 20.0,
) -> DataFrame:
    """Adds the retrain signals to batch statistics.

    ``max_abs_diff_pct``: the greatest absolute mean shift of any feature, as a number or as the
    one-row drift summary that holds it.
    """
    if isinstance(max_abs_diff_pct, DataFrame):
        shift = max_abs_diff_pct.select("max_abs_diff_pct").scalar()
    else:
        shift = F.lit(max_abs_diff_pct).cast("double")
    signals = {
        "low_average": F.col("avg_confidence") < min_avg_confidence,
        "many_unsure": F.col("low_confidence_pct") > max_low_confidence_pct,
        "features_moved": shift > max_feature_drift_pct,
    }
    marked = stats.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in signals.items()})
    return marked.withColumn("retrain", F.col("low_average") | F.col("many_unsure") | F.col("features_moved"))
