"""Profiles that roll up: quantile sketches and sums per day and slice, merged to longer spans without the rows.

A sketch keeps its values exactly up to some size and then a weighted sample of them; merging two sketches gives the
sketch of both. The rank of an estimated quantile is off by at most ``rank_bound(size)`` of the rows (with 99 %
confidence for any one quantile); the exact path next to it is ``ordering.exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_double, column, ratio
from tidemark.operators.ordering import match_keys

SIZE = 400
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def rank_bound(size: int = SIZE) -> float:
    """Normalised rank error of a sketch of this size (fixed values: the published fit for one quantile)."""
    return 2.296 / size**0.9021


def sketch_table(df: DataFrame, day: Column | str, features: Sequence[str], slices: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """Rows (day, *slices, feature, n, total, squares, low, high, sketch); a feature without values has no sketch.

    One aggregation with map-side parts: a day or slice with most of the rows sends one sketch per task. ``squares`` is
    the sum of squared distances from the mean, so that deviations merge without cancellation.
    """
    measures = []
    for i, f in enumerate(features):
        value = clean_double(f)
        n = F.count(value)
        measures += [
            n.alias(f"_n{i}"),
            F.sum(value).alias(f"_total{i}"),
            (F.var_pop(value) * n).alias(f"_squares{i}"),
            F.min(value).alias(f"_low{i}"),
            F.max(value).alias(f"_high{i}"),
            F.kll_sketch_agg_double(value, size).alias(f"_sketch{i}"),
        ]
    names = ("n", "total", "squares", "low", "high")
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            *[F.col(f"_{name}{i}").alias(name) for name in names],
            F.when(F.col(f"_n{i}") > 0, F.col(f"_sketch{i}")).alias("sketch"),
        )
        for i, f in enumerate(features)
    ]
    return df.groupBy(column(day).cast("date").alias("day"), *slices).agg(*measures).select("day", *slices, F.inline(F.array(*rows)))


def roll_up(sketches: DataFrame, by: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """The same table for coarser groups: ``by`` names columns, or gives them as expressions over day and slices.

    Reads sketches only, never rows; the result can be rolled up further (it has no day unless ``by`` gives one).
    """
    keys = by if isinstance(by, Mapping) else {name: F.col(name) for name in by}
    keyed = sketches.select(*[c.alias(name) for name, c in keys.items()], "feature", "n", "total", "squares", "low", "high", "sketch")
    group = [*keys, "feature"]
    centre = F.col("total") * F.col("total") / F.when(F.col("n") > 0, F.col("n"))
    n, total = F.sum("n"), F.sum("total")
    # within + between: the part's own squares, and the distance of its mean from the common one
    between = F.sum(centre) - total * total / F.when(n > 0, n)
    return keyed.groupBy(*group).agg(
        n.alias("n"),
        total.alias("total"),
        (F.sum("squares") + F.greatest(between, F.lit(0.0))).alias("squares"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def read_profile(sketches: DataFrame, by: Sequence[str], quantiles: Mapping[str, float] = QUARTILES) -> DataFrame:
    """Rows (*by, feature, count, mean, std, min, max, and the estimated quantiles) of a sketch table."""
    marks = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(name)
        for name, p in quantiles.items()
    ]
    std = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("std")
    mean = ratio("total", "n").alias("mean")
    return sketches.select(*by, "feature", F.col("n").alias("count"), mean, std, F.col("low").alias("min"), F.col("high").alias("max"), *marks)


def rank_errors(
    df: DataFrame, profile: DataFrame, feature: str, by: Mapping[str, Column], quantiles: Mapping[str, float] = QUARTILES
) -> DataFrame:
    """Rows (*by, quantile, count, rank_error): how far estimated quantiles of ``profile`` are off, by counting rows.

    An estimate has all ranks from the rows below it to the rows up to it; the error is the distance of the wanted
    share from that interval, as a share of the rows. One scan and one shuffle of counts; groups without values are left out.
    """
    names = list(by)
    kept = profile.filter((F.col("feature") == feature) & (F.col("count") > 0))
    kept = kept.select(*[F.col(n).alias(f"_{n}") for n in names], *[F.col(q).alias(f"_{q}") for q in quantiles])
    value = clean_double(feature)
    rows = df.select(*[c.alias(n) for n, c in by.items()], value.alias("_v")).filter(F.col("_v").isNotNull())
    counts = [F.count("*").alias("count")]
    for q in quantiles:
        counts += [F.count_if(F.col("_v") < F.col(f"_{q}")).alias(f"_below_{q}"), F.count_if(F.col("_v") <= F.col(f"_{q}")).alias(f"_upto_{q}")]
    found = rows.join(kept, match_keys(names)).groupBy(*names).agg(*counts)
    lines = []
    for q, p in quantiles.items():
        low, high = F.col(f"_below_{q}") / F.col("count"), F.col(f"_upto_{q}") / F.col("count")
        off = F.greatest(low - p, p - high, F.lit(0.0))
        lines.append(F.struct(F.lit(q).alias("quantile"), F.col("count").alias("count"), off.alias("rank_error")))
    return found.select(*names, F.inline(F.array(*lines)))
