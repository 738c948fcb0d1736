"""Descriptive statistics of tables and of prediction history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import clean_double, column, timestamp
from tidemark.operators.ordering import match_keys, quantiles_and_moments
from tidemark.operators.prep import numeric_columns
from tidemark.sources.workspace import Summary

LOW_CONFIDENCE = 0.7
STATS = ("count", "mean", "std", "min", "max")


def _aggregate(
    df: DataFrame, features: Sequence[str], by: Sequence[str], quantiles: Mapping[str, float], accuracy: int | None
) -> DataFrame:
    """Moments and quantiles of every feature in one aggregation."""
    functions = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    measures = [functions[s](clean_double(f)).alias(f"_{s}{i}") for i, f in enumerate(features) for s in STATS]
    if quantiles:
        points = F.array(*[F.lit(float(p)) for p in quantiles.values()])
        for i, f in enumerate(features):
            value = clean_double(f)
            marks = F.percentile(value, points) if accuracy is None else F.percentile_approx(value, points, accuracy)
            measures.append(marks.alias(f"_q{i}"))
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            *[F.col(f"_{s}{i}").alias(s) for s in STATS],
            *[F.get(f"_q{i}", F.lit(j)).alias(n) for j, n in enumerate(quantiles)],
        )
        for i, f in enumerate(features)
    ]
    return df.groupBy(*by).agg(*measures).select(*by, F.inline(F.array(*rows)))


def moments(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, feature, count, mean, std, min, max)``; every feature in one aggregation.

    Sample deviation; NULL and NaN are skipped.
    """
    return _aggregate(df, features, by, {}, None)


def _with_quantiles(
    df: DataFrame,
    features: Sequence[str],
    by: Sequence[str],
    quantiles: Mapping[str, float],
    accuracy: int | None,
) -> DataFrame:
    """Moments with quantiles: approximate on request, else exact.

    The built-in exact percentile keeps all distinct values of a group in memory, so quantiles come from cells.
    """
    by = list(by)
    if accuracy is not None:
        return _aggregate(df, features, by, quantiles, accuracy)
    keys = [*by, "feature"]
    long, sums = quantiles_and_moments(df, features, sorted(set(quantiles.values())), by)
    marks = long.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for n, p in quantiles.items()]
    )
    return sums.join(marks, match_keys(keys), "left").drop(*[f"_{k}" for k in keys])


def distribution_stats(
    df: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Rows ``(*by, feature, mean, std, min, max, median)``.

    The median interpolates and is exact; ``accuracy`` switches to the approximate percentile.
    """
    stats = _with_quantiles(df, features, by, {"median": 0.5}, accuracy)
    return stats.select(*by, "feature", "mean", "std", "min", "max", "median")


def describe_numeric(
    df: DataFrame,
    features: Sequence[str] | None = None,
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Rows ``(*by, feature, count, mean, std, min, p25, p50, p75, max)`` for the numeric columns."""
    features = numeric_columns(df) if features is None else list(features)
    stats = _with_quantiles(df, features, by, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, accuracy)
    return stats.select(*by, "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def non_null_info(df: DataFrame) -> DataFrame:
    """Rows ``(column, dtype, non_null, rows)`` in schema order, from one scan; NaN counts as missing."""
    present = [clean_double(f.name) if f.dataType in (T.DoubleType(), T.FloatType()) else F.col(f"`{f.name}`") for f in df.schema.fields]
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(f"_n{i}") for i, c in enumerate(present)])
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"_n{i}").alias("non_null"),
            F.col("_rows").alias("rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, name: str, pct: bool = False) -> DataFrame:
    """Rows ``(name, count[, pct])``, most frequent first, value as tie-break; NULL and NaN are dropped."""
    missing = F.col(name).isNull()
    if df.schema[name].dataType in (T.DoubleType(), T.FloatType()):
        missing |= F.isnan(name)
    counts = df.filter(~missing).groupBy(name).agg(F.count("*").alias("count"))
    if pct:
        counts = Summary(counts).rows  # read twice below, scanned once
        counts = counts.withColumn("pct", F.col("count") / counts.agg(F.sum("count")).scalar() * 100)
    return counts.orderBy(F.desc("count"), name)


def sorted_classes(df: DataFrame, name: str) -> DataFrame:
    """Distinct values with their counts in ascending order."""
    return df.groupBy(name).agg(F.count("*").alias("count")).orderBy(name)


def feature_means_by_date(df: DataFrame, day: Column | str, features: Sequence[str], name: str = "data_carga") -> DataFrame:
    """Average of every feature per load date."""
    return df.groupBy(column(day).alias(name)).agg(*[F.avg(clean_double(f)).alias(f"avg_{f}") for f in features])


def prediction_volume(preds: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Rows per combination of the dimensions plus all subtotals (``level`` 0 = finest).

    Rows are counted at the finest level first, so only counts are repeated for the subtotals.
    """
    finest = preds.groupBy(*dimensions).agg(F.count("*").alias("n"))
    return finest.rollup(*dimensions).agg(F.sum("n").alias("predictions"), F.grouping_id().alias("level"))


def confidence_histogram(preds: DataFrame, confidence: str = "prediction_probability", bins: int = 10) -> DataFrame:
    """Rows ``(bin, low, high, count)``; equal widths over [0, 1], 1.0 belongs to the last bin."""
    value = clean_double(confidence)
    index = F.least(F.floor(value * bins), F.lit(bins - 1)).cast("int")
    return (
        preds.filter(value.isNotNull())
        .groupBy(index.alias("bin"))
        .agg(F.count("*").alias("count"))
        .select("bin", (F.col("bin") / bins).alias("low"), ((F.col("bin") + 1) / bins).alias("high"), "count")
    )


def low_confidence(preds: DataFrame, confidence: str = "prediction_probability", limit: float = LOW_CONFIDENCE) -> DataFrame:
    """Rows strictly below the limit."""
    return preds.filter(F.col(confidence) < limit)


def low_confidence_rate(
    preds: DataFrame, by: Sequence[str], confidence: str = "prediction_probability", limit: float = LOW_CONFIDENCE
) -> DataFrame:
    """Rows ``(*by, low_confidence_count, total, low_confidence_pct)``."""
    low = F.count_if(clean_double(confidence) < limit)
    return preds.groupBy(*by).agg(
        low.alias("low_confidence_count"),
        F.count("*").alias("total"),
        (low / F.count("*") * 100).alias("low_confidence_pct"),
    )


def compare_profiles(
    base: DataFrame,
    prod: DataFrame,
    features: Sequence[str],
    accuracy: int | None = None,
) -> DataFrame:
    """Distribution statistics of both sides in one frame, keyed by ``side``."""
    both = base.select(*features, F.lit("baseline").alias("side")).unionByName(
        prod.select(*features, F.lit("production").alias("side"))
    )
    return distribution_stats(both, features, ["side"], accuracy)


def slice_profile(
    df: DataFrame,
    ts: str,
    features: Sequence[str],
    slices: Sequence[str] = (),
    granularity: str = "1 day",
    baseline: DataFrame | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Statistics per time window, slice and feature, next to the slice's baseline mean when given."""
    windowed = df.withColumn("window_start", F.window(timestamp(ts), granularity)["start"])
    by = ["window_start", *slices]
    stats = _with_quantiles(windowed, features, by, {"median": 0.5}, accuracy)
    if baseline is None:
        return stats
    keys = [*slices, "feature"]
    reference = moments(baseline, features, slices).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("mean").alias("baseline_mean")
    )
    return stats.join(reference, match_keys(keys), "left").drop(*[f"_{k}" for k in keys])


def preview(df: DataFrame, order: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)


