"""Exact, reproducible train/test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_before
from tidemark.sources.workspace import Summary, durable

DIGITS = 3  # hex digits per refinement level: 4096 buckets


def _text(key: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in key])


def _draw(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), _text(key)))


def class_quotas(counts: DataFrame, fractions: Mapping[str, float]) -> DataFrame:
    """Rows to take per class and part, from rows ``(class, n)``.

    Part size is ``ceil(fraction * N)``; a class gets the floor of its proportional share and the
    largest remainders get one more each (lowest class first on a tie). Integer arithmetic.
    """
    wide = counts.withColumn("total", F.sum("n").over(Window.partitionBy()).cast("decimal(38,0)"))
    for i, fraction in enumerate(fractions.values()):
        # rounding first keeps 0.2 * 15 at 3 instead of 3.0000000000000004
        size = F.ceil(F.round(F.lit(float(fraction)) * F.col("total").cast("double"), 6)).cast("decimal(18,0)")
        share = size * F.col("n").cast("decimal(18,0)")
        wide = wide.withColumn(f"_base{i}", F.call_function("div", share, F.col("total")))
        wide = wide.withColumn(f"_size{i}", size).withColumn(f"_rest{i}", share % F.col("total"))
        order = Window.orderBy(F.col(f"_rest{i}").desc(), F.col("class"))
        left = F.col(f"_size{i}") - F.sum(f"_base{i}").over(Window.partitionBy())
        extra = F.when(F.row_number().over(order) <= left, 1).otherwise(0)
        wide = wide.withColumn(f"quota{i}", (F.col(f"_base{i}") + extra).cast("bigint"))
    return wide.select("class", "n", *[f"quota{i}" for i in range(len(fractions))])


def stratified_split(
    df: DataFrame,
    label: str | None,
    key: Sequence[str],
    fractions: Mapping[str, float] | None = None,
    seed: int = 42,
    rest: str = "train",
) -> DataFrame:
    """Adds ``split``: exact per-class quotas, the same rows for any partitioning.

    Rows of a class are ranked by ``md5(seed|key)``; the first part takes the lowest ranks, the next
    part the following ones, ``rest`` what remains. All that is needed is the last hash of each class
    and part; a map-only pass then compares every row with these cut-offs. One histogram over class and
    leading hash digits gives the class counts and the bucket each quota falls into; the rows of those
    buckets alone (one of 4,096 for each cut) are written as hashes, refined once more and sorted.

    ``key`` must identify a row; rows sharing a key always land on the same side.
    """
    fractions = {"test": 0.2} if fractions is None else dict(fractions)
    parts = list(fractions)
    if not parts or min(fractions.values()) <= 0 or sum(fractions.values()) >= 1:
        raise ValueError(f"fractions must be positive and leave rows for '{rest}': {fractions}")
    stratum = F.lit(0) if label is None else F.col(label)
    hashed = df.select(
        stratum.alias("class"),
        _draw(key, seed).alias("h"),
        _text(key).alias("k"),
    )
    first = F.substring("h", 1, DIGITS)
    histogram = Summary(hashed.groupBy("class", first.alias("b1")).agg(F.count("*").alias("n")))
    counts = Summary(histogram.rows.groupBy("class").agg(F.sum("n").alias("n")))
    _require_splittable(counts.rows, fractions, stratified=label is not None)
    bounds = Summary(
        class_quotas(counts.rows, fractions).select(
            "class",
            F.posexplode(
                F.array(*[sum((F.col(f"quota{j}") for j in range(i)), F.col(f"quota{i}")) for i in range(len(parts))])
            ).alias("part", "bound"),
        )
    )
    cuts = Summary(
        _refined_cuts(hashed, histogram.rows, bounds)
        .groupBy("class")
        .agg(F.map_from_entries(F.collect_list(F.struct("part", "at"))).alias("cuts"))
    )
    choice = F.when(F.lit(False), F.lit(rest))
    for i, name in enumerate(parts):
        choice = choice.when(F.col("_place") <= F.try_element_at(F.col("cuts"), F.lit(i)), F.lit(name))
    limits = cuts.joinable(cuts.rows.withColumnRenamed("class", "_class"))
    return (
        df.withColumn("_place", F.struct(_draw(key, seed).alias("h"), _text(key).alias("k")))
        .join(limits, stratum.eqNullSafe(F.col("_class")), "left")
        .withColumn("split", choice.otherwise(F.lit(rest)))
        .drop("_place", "_class", "cuts")
    )


def _refined_cuts(hashed: DataFrame, histogram: DataFrame, bounds: Summary) -> DataFrame:
    """Last place of every class and part by refinement: only rows that share two hash prefixes with a cut are sorted."""
    first, second = F.substring("h", 1, DIGITS), F.substring("h", DIGITS + 1, DIGITS)
    level1 = histogram.withColumn("start", running_before("n", ["class"], "b1"))
    cut1 = Summary(_containing(level1, bounds, ["class"], "b1"))
    # the source is not read again for what follows
    hashed = durable(_restrict(hashed, cut1, ["class", "b1"], [F.col("class"), first]))
    inside = hashed
    level2 = inside.groupBy("class", "b1", second.alias("b2")).agg(
        F.count("*").alias("n"), F.any_value("start").alias("base")
    )
    level2 = level2.withColumn("start", F.col("base") + running_before("n", ["class", "b1"], "b2"))
    cut2 = Summary(_containing(level2, bounds, ["class", "b1"], "b2"))
    inside = _restrict(hashed.drop("b1", "start"), cut2, ["class", "b1", "b2"], [F.col("class"), first, second])
    placed = inside.groupBy("class", "b1", "b2", F.struct("h", "k").alias("at")).agg(
        F.count("*").alias("n"), F.any_value("start").alias("base")
    )
    placed = placed.withColumn("start", F.col("base") + running_before("n", ["class", "b1", "b2"], "at"))
    return _containing(placed, bounds, ["class"], "at")


def _containing(placed: DataFrame, bounds: Summary, groups: list[str], bucket: str) -> DataFrame:
    """Buckets (with their start rank) that hold the last row of a part."""
    edges = bounds.joinable(bounds.rows.withColumnRenamed("class", "_c"))
    holds = (
        F.col("class").eqNullSafe(F.col("_c"))
        & (F.col("start") < F.col("bound"))
        & (F.col("bound") <= F.col("start") + F.col("n"))
    )
    return placed.join(edges, holds).select(*groups, bucket, "start", "part")


def _restrict(hashed: DataFrame, cut: Summary, names: list[str], values: list[Column]) -> DataFrame:
    """Rows of the chosen buckets only, with the bucket columns and start rank attached."""
    chosen = cut.rows.select(*names, "start").distinct()
    chosen = cut.joinable(chosen.withColumnsRenamed({n: f"_{n}" for n in names}))
    match = reduce(lambda a, b: a & b, [v.eqNullSafe(F.col(f"_{n}")) for n, v in zip(names, values)])
    joined = hashed.join(chosen, match)
    return joined.select("class", "h", "k", *[F.col(f"_{n}").alias(n) for n in names if n != "class"], "start")


def _require_splittable(counts: DataFrame, fractions: Mapping[str, float], stratified: bool) -> None:
    """ValueError when a part could not hold every class."""
    facts = counts.agg(F.sum("n").alias("rows"), F.min("n").alias("rarest"), F.count("*").alias("classes")).first()
    if not facts["rows"]:
        raise ValueError("cannot split an empty table")
    if not stratified:
        return
    if facts["rarest"] < 2:
        raise ValueError("the least populated class has fewer than 2 rows")
    taken = 0
    for name, fraction in fractions.items():
        size = -int(-round(fraction * facts["rows"], 6) // 1)
        taken += size
        if size < facts["classes"]:
            raise ValueError(f"part '{name}' would have fewer rows than there are classes")
    if facts["rows"] - taken < facts["classes"]:
        raise ValueError("the remaining part would have fewer rows than there are classes")


def part(df: DataFrame, name: str) -> DataFrame:
    """Rows of one part, without the ``split`` column."""
    return df.filter(F.col("split") == name).drop("split")
