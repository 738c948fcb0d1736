"""Exact order statistics without a one-task sort.

Each feature's value range is cut into ordered *cells*: a quantile sketch gives the edges, and every
edge interval is split into up to ``FAN`` equal widths, fewer where there are many groups. Edges only
steer balance; results are exact for any edges. A tally per cell gives the rank at which the cell
starts, so most cells are settled from the tally alone and only those that matter are looked into value
by value. Moments come with the sketch, in its scan. Equal
values always share a cell and collapse to one counted row before any window runs, so a value held
by a third of all rows costs one row. The plan is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_double
from tidemark.sources.workspace import Summary, durable

LEVELS = 8  # up to 2**LEVELS - 1 edges, found by LEVELS halving steps
FAN = 64
#: Cells of all groups together, about, that a tally is laid out for.
CELLS = 1 << 16
#: Size of the sketch behind the edges: their ranks are off by some 0.3 % of the rows.
SKETCH = 1 << 10


@dataclass(frozen=True)
class CellGrid:
    """Strictly increasing edges per feature, and the widths that an interval is cut into."""

    edges: dict[str, list[float]]
    fan: int


def to_values(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long rows ``(*keep, feature, value)``, one per non-null feature value.

    ``feature`` is the position in ``features``: a number keeps grouping and shuffles light.
    """
    values = F.array(*[clean_double(f) for f in features])
    return df.select(*keep, F.posexplode(values).alias("feature", "value")).filter(F.col("value").isNotNull())


def feature_name(features: Sequence[str]) -> Column:
    """The name behind a feature position."""
    return F.get(F.array(*[F.lit(f) for f in features]), F.col("feature")).alias("feature")


def _marks() -> Column:
    count = 2**LEVELS - 1
    return F.array(*[F.lit(i / (count - 1)) for i in range(count)])


def _grid(sketches: DataFrame, features: Sequence[str]) -> CellGrid:
    """From rows with one sketch ``_s{i}`` and one count ``_n{i}`` for each feature; every row is a group."""
    merged = [F.kll_merge_agg_double(F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}"))).alias(f"_s{i}") for i in range(len(features))]
    whole = sketches.agg(*merged, *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(features))], F.count("*").alias("_groups"))
    edges = [F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_s{i}", _marks())).alias(f"_q{i}") for i in range(len(features))]
    row = whole.select(*edges, "_groups").first()
    fan = max(1, min(FAN, CELLS // (2**LEVELS * max(1, row["_groups"]))))
    return CellGrid({f: sorted({q for q in row[f"_q{i}"] or () if math.isfinite(q)}) for i, f in enumerate(features)}, fan)


def _sketches(features: Sequence[str]) -> list[Column]:
    """The columns that ``_grid`` reads."""
    values = list(enumerate(map(clean_double, features)))
    return [F.kll_sketch_agg_double(v, SKETCH).alias(f"_s{i}") for i, v in values] + [F.count(v).alias(f"_n{i}") for i, v in values]


def cell_grid(df: DataFrame, features: Sequence[str]) -> CellGrid:
    """Edges from quantile sketches: one column-pruned scan, merged from the tasks' parts."""
    return _grid(df.agg(*_sketches(features)), features)


def to_cells(df: DataFrame, grid: CellGrid, keep: Sequence[str] = ()) -> DataFrame:
    """Long rows ``(*keep, feature, cell, value)``, one per non-null value; ``feature`` is a position.

    A value's interval is found by halving steps over the padded edges of its feature, then its
    place inside the interval by proportion. Both never decrease with the value.
    """
    size = 2**LEVELS - 1
    width = size + 2
    padded = [[-math.inf, *edges, *[math.inf] * (size - len(edges) + 1)] for edges in grid.edges.values()]
    # one text literal, folded to an array once: a literal per edge would slow the analysis of every step
    table = F.split(F.lit(",".join(str(x) for edges in padded for x in edges)), ",").cast("array<double>")
    long = to_values(df, list(grid.edges), keep).withColumn("_at", F.col("feature") * width)
    for level in reversed(range(LEVELS)):
        further = F.col("_at") + F.lit(2**level)
        long = long.withColumn("_at", F.when(F.get(table, further) <= F.col("value"), further).otherwise(F.col("_at")))
    low, high = F.get(table, F.col("_at")), F.get(table, F.col("_at") + 1)
    share = F.nanvl((F.col("value") - low) / (high - low), F.lit(1.0))
    inner = F.least(F.floor(share * grid.fan), F.lit(grid.fan - 1))
    cell = (F.col("_at") - F.col("feature") * width) * grid.fan + inner
    return long.select(*keep, "feature", cell.cast("int").alias("cell"), "value")


def running_before(counter: str, partition: Sequence[str], order: str) -> Column:
    """Sum of ``counter`` over the rows strictly before the current one."""
    window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(counter).over(window), F.lit(0))


def match_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality of every key with its copy named ``_key`` on the other side."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def exact_quantiles(
    df: DataFrame,
    features: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Interpolated quantiles, rows ``(*by, feature, probability, value)``."""
    return quantiles_and_moments(df, features, probabilities, by)[0]


def quantiles_and_moments(
    df: DataFrame,
    features: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Interpolated quantiles ``(*by, feature, probability, value)``, and the moments of all groups and features.

    Moments are ``(*by, feature, count, mean, std, min, max)``, with sample deviation; they are taken in the scan that
    sketches the edges. Only the cells that hold a wanted rank are read value by value.
    """
    by = list(by)
    key = [*by, "feature"]
    functions = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    measures = [f(clean_double(c)).alias(f"_{n}{i}") for i, c in enumerate(features) for n, f in functions.items()]
    look = durable(df.groupBy(*by).agg(*measures, *_sketches(features)))
    lines = [F.struct(F.lit(c).alias("feature"), *[F.col(f"_{n}{i}").alias(n) for n in functions]) for i, c in enumerate(features)]
    moments = look.select(*by, F.inline(F.array(*lines)))
    long = to_cells(df, _grid(look, features), by)
    tally = Summary(long.groupBy(*key, "cell").agg(F.count("*").alias("n")))
    placed = tally.rows.select(
        *key,
        "cell",
        "n",
        running_before("n", key, "cell").alias("start"),
        F.sum("n").over(Window.partitionBy(*key)).alias("total"),
    )
    ranks = []
    for p in probabilities:
        position = F.lit(float(p)) * (F.col("total") - 1)
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            ranks.append(
                F.struct(
                    F.lit(float(p)).alias("probability"),
                    F.lit(side).alias("side"),
                    rank.cast("bigint").alias("rank"),
                    (position - F.floor(position)).alias("weight"),
                )
            )
    wanted = placed.withColumn(
        "ranks",
        F.filter(F.array(*ranks), lambda r: (r["rank"] >= F.col("start")) & (r["rank"] < F.col("start") + F.col("n"))),
    ).filter(F.size("ranks") > 0)
    chosen = Summary(wanted.select(*[F.col(k).alias(f"_{k}") for k in [*key, "cell"]], "start", "ranks"))
    wanted = chosen.joinable()
    values = (
        long.join(wanted, match_keys([*key, "cell"]), "left_semi")
        .groupBy(*key, "cell", "value")
        .agg(F.count("*").alias("n"))
        .join(wanted, match_keys([*key, "cell"]))
    )
    ranked = values.withColumn("first", F.col("start") + running_before("n", [*key, "cell"], "value"))
    picked = ranked.select(
        *key,
        "value",
        F.explode(
            F.filter(
                "ranks", lambda r: (r["rank"] >= F.col("first")) & (r["rank"] < F.col("first") + F.col("n"))
            )
        ).alias("r"),
    )
    low = F.max(F.when(F.col("r.side") == "low", F.col("value")))
    high = F.max(F.when(F.col("r.side") == "high", F.col("value")))
    weight = F.max("r.weight")
    found = picked.groupBy(*key, F.col("r.probability").alias("probability")).agg(
        F.when(weight == 0, low).otherwise((F.lit(1.0) - weight) * low + weight * high).alias("value")
    )
    return found.select(*by, feature_name(features), "probability", "value"), moments
