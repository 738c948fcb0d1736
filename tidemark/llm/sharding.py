"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Every partition permutes its rows locally. From the partition sizes alone the driver draws how many rows each
partition sends to each shard: exactly the multivariate hypergeometric counts of a uniform permutation. Rows
take their shard from their local rank, are exchanged, and are permuted again. Everything that touches rows is
DataFrame expressions; the driver holds one count per partition and shard.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import all_columns, stored
from tidemark.sources.workspace import literal_frame

#: Rows that one task permutes in the second pass, about.
BLOCK_ROWS = 1 << 14


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good. Exact ratio-of-uniforms rejection: constant time at any size."""
    total = good + bad
    if draws == 0 or good == 0:
        return 0
    if bad == 0 or draws == total:
        return min(draws, good)
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low

    def log_weight(k: int) -> float:
        return -(math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(draws - k + 1) + math.lgamma(bad - draws + k + 1))

    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    top = log_weight(mode)
    if high - low <= 64:  # few values: invert the distribution itself
        weights = [math.exp(log_weight(k) - top) for k in range(low, high + 1)]
        return rng.choices(range(low, high + 1), weights)[0]
    # for unimodal weights v = u * width covers the region under sqrt(weight); every point of it is equally likely
    mean = draws * good / total
    spread = math.sqrt(mean * (bad / total) * (total - draws) / max(1, total - 1) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        u = 1.0 - rng.random()
        k = math.floor(mean + 0.5 + width * (rng.random() - 0.5) / u)
        if low <= k <= high and 2 * math.log(u) <= log_weight(k) - top:
            return k


def matrix(sizes: list[int], targets: list[int], seed: int) -> list[list[int]]:
    """Counts by partition and shard with these row and column sums, as a uniform permutation would give them."""
    rng, left, rows = random.Random(seed), list(targets), []
    for size in sizes:
        remaining, row, rest = size, [], sum(left)
        for j, room in enumerate(left):
            rest -= room
            taken = hypergeometric(rng, room, rest, remaining)
            row.append(taken)
            remaining -= taken
        left = [a - b for a, b in zip(left, row)]
        rows.append(row)
    return rows


def shuffle_into_shards(rows: DataFrame, shards: int = 16, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All columns of ``rows`` plus shard (0 to shards - 1) and slot (gapless from 0 in its shard).

    Shard sizes differ by one row at most. Every assignment of rows to (shard, slot) is equally likely over seeds;
    equal rows, nulls and empty texts are shuffled like any others, so copies need not meet in one shard. The
    result is the same for the same stored input and seed. An empty table gives no rows. Input columns named
    ``shard`` or ``slot`` are replaced.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    columns = all_columns(rows)
    key = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), *columns)
    # permute locally: no exchange; the position inside the partition is the local rank
    local = rows.withColumn("__first", key("first")).sortWithinPartitions("__first", key("ties"))
    position = F.monotonically_increasing_id()
    local = local.withColumn("__at", position).withColumn("__part", F.shiftright("__at", 33)).withColumn("__rank", F.col("__at").bitwiseAND((1 << 33) - 1))
    local = stored(local.drop("__at", "__first"), "permuted")
    found = sorted((r["__part"], r["n"]) for r in local.groupBy("__part").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in found)
    targets = [total // shards + (j < total % shards) for j in range(shards)]
    drawn = matrix([n for _, n in found], targets, seed)
    edges = [[sum(row[: j + 1]) for j in range(shards)] for row in drawn]
    counts = literal_frame(spark, {"__part": [p for p, _ in found], "__edges": edges}) if found else spark.createDataFrame([], "__part long, __edges array<long>")
    # one short row per partition of the input
    sent = local.join(F.broadcast(counts), "__part").withColumn("shard", F.size(F.filter("__edges", lambda e: e <= F.col("__rank"))).cast("int"))
    # exchange, and permute again: blocks of a second random key, so that a large shard is many tasks
    blocks = max(1, -(-total // (shards * block_rows)))
    sent = sent.withColumn("__second", key("second")).withColumn("__block", F.floor((F.col("__second") / F.lit(2.0**64) + 0.5) * blocks).cast("long"))
    sent = sent.drop("__edges")
    sizes = sent.groupBy("shard", "__block").agg(F.count("*").alias("__n"))
    starts = sizes.select("shard", "__block", (F.sum("__n").over(Window.partitionBy("shard").orderBy("__block")) - F.col("__n")).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("shard", "__block").orderBy("__second", "__part", "__rank")) - 1
    placed = sent.withColumn("__inside", inside).join(starts, ["shard", "__block"])
    return placed.select(*columns, "shard", (F.col("__start") + F.col("__inside")).cast("long").alias("slot"))
