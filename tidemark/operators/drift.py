"""Feature, prediction and performance drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import column, ks_tail_probability, ratio, ratio_or_zero, timestamp
from tidemark.functions.exact_ks import EXACT_MAX_ROWS, exact_p_value
from tidemark.operators.evaluate import confusion_counts, weighted_metrics
from tidemark.operators.ordering import (
    cell_grid,
    feature_name,
    match_keys,
    running_before,
    to_cells,
)
from tidemark.operators.profile import moments
from tidemark.sources.workspace import Summary, literal_frame

TEST_COLUMNS = ("feature", "n_base", "n_prod", "drift_score", "p_value", "has_drift")
STABLE = "Production model is stable, no action needed"
RETRAIN = "Investigate the drift, collect recent representative data and retrain"


def ks_distance(
    base: DataFrame,
    prod: DataFrame,
    features: Sequence[str],
    null_policy: str = "drop",
) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov distance, rows ``(feature, n_base, n_prod, drift_score)``.

    ``null_policy='propagate'`` gives a NULL distance to a feature with any NULL or NaN.
    """
    return _distance_and_means(base, prod, features, null_policy).select("feature", "n_base", "n_prod", "drift_score")


def _distance_and_means(base: DataFrame, prod: DataFrame, features: Sequence[str], null_policy: str = "drop") -> DataFrame:
    """Rows ``(feature, n_base, n_prod, drift_score, baseline_mean, production_mean)``, all from one tally of both sides."""
    if null_policy not in ("drop", "propagate"):
        raise ValueError(f"unknown null_policy: {null_policy}")
    both = base.select(*features, F.lit(1).alias("_base")).unionByName(prod.select(*features, F.lit(0).alias("_base")))
    found = _cell_distance(both, features).withColumnRenamed("feature", "_feature")
    names = literal_frame(base.sparkSession, {"feature": list(features)})
    zero = F.lit(0).cast("bigint")
    result = names.join(found, F.col("feature") == F.col("_feature"), "left").select(
        "feature",
        F.coalesce("n", zero).alias("n_base"),
        F.coalesce("m", zero).alias("n_prod"),
        F.col("d").alias("drift_score"),
        ratio("sb", "n").alias("baseline_mean"),
        ratio("sp", "m").alias("production_mean"),
    )
    if null_policy == "drop":
        return result
    sizes = both.agg(F.struct(_in_base().alias("b"), _in_prod().alias("p"))).scalar()
    whole = (F.col("n_base") == sizes["b"]) & (F.col("n_prod") == sizes["p"])
    return result.withColumn("drift_score", F.when(whole, F.col("drift_score")))


def _in_base() -> Column:
    return F.sum("_base")


def _in_prod() -> Column:
    return F.sum(1 - F.col("_base"))


def _cell_distance(both: DataFrame, features: Sequence[str]) -> DataFrame:
    """The distance from ordered cells.

    The gap between the two distribution functions is known at every cell edge from the tally alone.
    Inside a cell it cannot exceed what the cell's own rows could add, so only cells whose bound
    beats the best edge gap are shuffled value by value.
    """
    long = to_cells(both, cell_grid(both, features), ["_base"])
    tally = Summary(
        long.groupBy("feature", "cell").agg(
            _in_base().alias("cb"),
            _in_prod().alias("cp"),
            F.sum(F.col("value") * F.col("_base")).alias("sb"),
            F.sum(F.col("value") * (1 - F.col("_base"))).alias("sp"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    whole = Window.partitionBy("feature")
    cells = tally.rows.select(
        "*",
        running_before("cb", ["feature"], "cell").alias("b0"),
        running_before("cp", ["feature"], "cell").alias("p0"),
        F.sum("cb").over(whole).alias("n"),
        F.sum("cp").over(whole).alias("m"),
    )
    b0, b1 = ratio("b0", "n"), ratio(F.col("b0") + F.col("cb"), "n")
    p0, p1 = ratio("p0", "m"), ratio(F.col("p0") + F.col("cp"), "m")
    cells = cells.withColumns({"edge": F.abs(b1 - p1), "reach": F.greatest(F.abs(b1 - p0), F.abs(b0 - p1))})
    cells = cells.withColumn("best", F.max("edge").over(whole))
    edges = cells.groupBy("feature").agg(F.max("n").alias("n"), F.max("m").alias("m"), F.max("edge").alias("edge"), F.sum("sb").alias("sb"), F.sum("sp").alias("sp"))
    key = ["feature", "cell"]
    open_cells = cells.filter((F.col("low") < F.col("high")) & (F.col("reach") > F.col("best"))).select(
        F.col("feature").alias("_feature"), F.col("cell").alias("_cell"), "b0", "p0", "n", "m"
    )
    open_cells = tally.joinable(open_cells)
    inside = (
        long.join(open_cells, match_keys(key), "left_semi")
        .groupBy(*key, "value")
        .agg(_in_base().alias("cb"), _in_prod().alias("cp"))
        .join(open_cells, match_keys(key))
    )
    upto = Window.partitionBy(*key).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.abs(
        ratio(F.col("b0") + F.sum("cb").over(upto), "n") - ratio(F.col("p0") + F.sum("cp").over(upto), "m")
    )
    inner = inside.select(F.col("feature").alias("_feature"), gap.alias("gap")).groupBy("_feature").agg(
        F.max("gap").alias("gap")
    )
    return edges.join(inner, match_keys(["feature"]), "left").select(
        feature_name(features), "n", "m", F.greatest("edge", "gap").alias("d"), "sb", "sp"
    )


def ks_two_sample(
    base: DataFrame,
    prod: DataFrame,
    features: Sequence[str],
    threshold: float = 0.05,
    method: str = "asymp",
    null_policy: str = "drop",
) -> DataFrame:
    """Drift test per feature: ``(feature, n_base, n_prod, drift_score, p_value, has_drift)``.

    ``method`` is the caller's choice: ``asymp`` (default), ``limit``, ``exact`` (an error where a
    side has more than 10,000 values: its work grows with their product), or ``auto``, exact for
    features of up to 10,000 values a side and ``asymp`` for others. Drift means
    ``p_value < threshold``, strictly; an empty side gives NULL and no drift. Runs the distance job
    right away, for its one row per feature.
    """
    return _tested(ks_distance(base, prod, features, null_policy), threshold, method)


def _tested(distances: DataFrame, threshold: float = 0.05, method: str = "asymp") -> DataFrame:
    """Adds ``p_value`` and ``has_drift`` to rows with ``drift_score``, ``n_base`` and ``n_prod``."""
    sizes = F.col("drift_score"), F.col("n_base"), F.col("n_prod")
    small = F.greatest("n_base", "n_prod") <= EXACT_MAX_ROWS
    if method not in ("auto", "exact", "asymp", "limit"):
        raise ValueError(f"unknown method: {method}")
    rows = Summary(distances).rows
    if method == "exact" and (large := [r["feature"] for r in rows.filter(~small).collect()]):
        raise ValueError(f"no exact p-value beyond {EXACT_MAX_ROWS} values a side: {large}")
    if method in ("asymp", "limit") or (method == "auto" and rows.filter(small).isEmpty()):
        p = ks_tail_probability(*sizes, "limit" if method == "limit" else "asymp")
    else:
        p = exact_p_value(*sizes)
        if method == "auto":
            p = F.when(small, p).otherwise(ks_tail_probability(*sizes))
    return rows.withColumn("p_value", p).withColumn(
        "has_drift", F.coalesce(F.col("p_value") < threshold, F.lit(False))
    )


def mean_diff(base: DataFrame, prod: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows ``(feature, baseline_mean, production_mean, diff_pct)``; NULL percent on a zero baseline."""
    both = base.select(*features, F.lit("b").alias("_side")).unionByName(prod.select(*features, F.lit("p").alias("_side")))
    means = moments(both, features, ["_side"]).groupBy("feature").agg(
        F.max(F.when(F.col("_side") == "b", F.col("mean"))).alias("baseline_mean"),
        F.max(F.when(F.col("_side") == "p", F.col("mean"))).alias("production_mean"),
    )
    return means.withColumn("diff_pct", ratio(F.col("production_mean") - F.col("baseline_mean"), "baseline_mean") * 100)


def any_drift(results: DataFrame) -> DataFrame:
    """One row: did any feature drift (false for no features)."""
    return results.agg(F.coalesce(F.bool_or("has_drift"), F.lit(False)).alias("any_drift"))


def drift_details(base: DataFrame, prod: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """The drift test and the mean comparison, one row per feature, from one tally of both sides."""
    found = _distance_and_means(base, prod, features, options.pop("null_policy", "drop"))
    moved = ratio(F.col("production_mean") - F.col("baseline_mean"), "baseline_mean") * 100
    tested = _tested(found, **options).withColumn("diff_pct", moved)
    return tested.select(*TEST_COLUMNS, "baseline_mean", "production_mean", "diff_pct")


def summarize_drift(details: DataFrame) -> DataFrame:
    """One row: any drift, the drifted features in name order, the greatest mean shift, the advice."""
    return details.agg(
        F.coalesce(F.bool_or("has_drift"), F.lit(False)).alias("any_drift"),
        F.sort_array(F.collect_list(F.when(F.col("has_drift"), F.col("feature")))).alias("drifted_features"),
        F.max(F.abs("diff_pct")).alias("max_abs_diff_pct"),
    ).withColumn("recommendation", F.when(F.col("any_drift"), F.lit(RETRAIN)).otherwise(F.lit(STABLE)))


def drift_report(base: DataFrame, prod: DataFrame, features: Sequence[str], **options) -> DataFrame:
    return summarize_drift(drift_details(base, prod, features, **options))


def prediction_drift(
    base: DataFrame, recent: DataFrame, confidence: str = "prediction_probability", **options
) -> DataFrame:
    """The drift test on the confidence of two prediction sets."""
    return ks_two_sample(base, recent, [confidence], **options)


def class_share_drift(base: DataFrame, recent: DataFrame, name: str = "predicted_class") -> DataFrame:
    """Rows ``(class, baseline_share, recent_share, share_diff)`` over the union of classes."""
    both = base.select(name, F.lit(1).alias("_base")).unionByName(recent.select(name, F.lit(0).alias("_base")))
    both = both.filter(F.col(name).isNotNull())
    counts = Summary(both.groupBy(F.col(name).alias("class")).agg(_in_base().alias("b"), _in_prod().alias("r"))).rows
    sums = counts.agg(F.struct(F.sum("b").alias("b"), F.sum("r").alias("r"))).scalar()
    return counts.select(
        "class",
        ratio_or_zero("b", sums["b"]).alias("baseline_share"),
        ratio_or_zero("r", sums["r"]).alias("recent_share"),
    ).withColumn("share_diff", F.col("recent_share") - F.col("baseline_share"))


def performance_by_window(
    labelled: DataFrame,
    ts: Column | str,
    label: str = "target",
    prediction: str = "predicted_class",
    granularity: str = "1 day",
    baseline_accuracy: float | None = None,
) -> DataFrame:
    """Accuracy, precision, recall and F1 per time window, with the drop against a baseline."""
    windowed = labelled.withColumn("window_start", F.window(timestamp(column(ts)), granularity)["start"])
    metrics = weighted_metrics(confusion_counts(windowed, label, prediction, ["window_start"]), ["window_start"])
    if baseline_accuracy is None:
        return metrics
    return metrics.withColumn("accuracy_change", F.col("accuracy") - F.lit(float(baseline_accuracy))).withColumn(
        "degraded", F.col("accuracy_change") < 0
    )
