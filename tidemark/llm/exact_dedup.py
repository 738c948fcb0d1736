"""Exact duplicates by a Golomb-coded fingerprint exchange.

Texts are equal when they are the same after each run of ASCII white space becomes one space. Partitions
store a narrow digest of their rows and send the sorted, Golomb-Rice coded 64-bit fingerprints to the owners
of hash ranges; owners answer with duplicate bitmaps. Only rows marked there (or repeated inside their
partition) are suspects: their texts alone are shuffled, and grouping by the text itself verifies the bytes.
Grouping combines copies before the shuffle, so a text held by a third of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import KeyFilter, all_columns, parallelism, split_by_keys, stored, text_or_empty
from tidemark.llm.golomb import by_owner, encode, shared_bitmaps

SPACE = r"[\x20\x09-\x0D]+"
DIGEST = "doc_id long, h long, sha binary, part int, owner int, blob binary"


def normalised(text: str = "text"):
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def _digests(docs: DataFrame, owners: int) -> DataFrame:
    """Rows (doc_id, h, sha, part), and rows (part, owner, blob) with each partition's coded fingerprints."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("sha", pa.binary()), ("part", pa.int32()), ("owner", pa.int32()), ("blob", pa.binary())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), []
        for batch in batches:
            n = batch.num_rows
            seen.append(batch.column("h").to_numpy().view(np.uint64))
            columns = [batch.column("doc_id"), batch.column("h"), batch.column("sha").cast(pa.binary()), pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        values = np.unique(np.concatenate(seen)) if seen else np.empty(0, np.uint64)
        sent = [(owner, encode(own)) for owner, own in by_owner(values, owners)]
        n = len(sent)
        columns = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array([part] * n, pa.int32()), pa.array([o for o, _ in sent], pa.int32()), pa.array([b for _, b in sent], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    norm = docs.select(F.col("doc_id").cast("long"), normalised().alias("norm"))
    keyed = norm.select("doc_id", F.xxhash64("norm").alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    return keyed.mapInArrow(digest, DIGEST)


def _marked(digests: DataFrame, owners: int) -> DataFrame:
    """(doc_id, h, sha, suspect): bitmaps brought back to the partitions whose lists they answer."""
    rows = digests.where("owner is null").select("doc_id", "h", "sha", "part")
    bitmaps = shared_bitmaps(digests.where("owner is not null").select("part", "owner", "blob"))
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("sha", pa.binary()), ("suspect", pa.bool_())])

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        h = left.column("h").to_numpy().view(np.uint64)
        values, where, copies = np.unique(h, return_inverse=True, return_counts=True)
        answers = dict(zip(right.column("owner").to_pylist(), right.column("bitmap").to_pylist()))
        bits = [np.unpackbits(np.frombuffer(answers[owner], np.uint8))[: len(own)] for owner, own in by_owner(values, owners)]
        suspect = (np.concatenate(bits).astype(bool) | (copies > 1))[where]
        return pa.table([left.column("doc_id"), left.column("h"), left.column("sha").cast(pa.binary()), pa.array(suspect)], schema=schema)

    return rows.groupBy("part").cogroup(bitmaps.groupBy("part")).applyInArrow(mark, "doc_id long, h long, sha binary, suspect boolean")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Reads ``doc_id`` and ``text`` only; other columns are ignored, whatever their names. A null text is empty.
    Of equal texts the smallest doc_id stays; repeated rows of that id all count as kept and count in
    group_size. A null doc_id never becomes keep_id unless the whole group lacks ids (then all its rows stay,
    with keep_id null). An empty table gives an empty result.
    """
    spark = docs.sparkSession
    owners = parallelism(spark)
    marked = stored(_marked(stored(_digests(docs, owners), "digests"), owners), "suspects")
    wanted = spark.sparkContext.broadcast(KeyFilter.build(marked.where("suspect").select("h").distinct()))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = wanted.value.has(batch.column("h").to_numpy().view(np.uint64))
            if hit.any():
                yield batch.filter(pa.array(hit)).select(["doc_id", "norm"])

    texts = docs.select(F.col("doc_id").cast("long"), normalised().alias("norm")).withColumn("h", F.xxhash64("norm"))
    copies = texts.mapInArrow(suspects, "doc_id long, norm string").groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = copies.where("group_size > 1").select(F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    found = marked.where("suspect").select("doc_id", "sha").join(groups, "sha", "left")
    digest = F.lower(F.hex("sha")).alias("text_sha256")
    grouped = F.col("group_size").isNotNull()
    keep = F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id"))
    several = found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), digest)
    single = marked.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest)
    return several.unionByName(single)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns; of repeated rows of one doc_id with equal text, one.

    Rows without doc_id stay.
    """
    result = stored(exact_groups(docs).select("doc_id", "kept", "text_sha256"), "kept")
    dropped = result.where("not kept and doc_id is not null").select("doc_id", F.col("text_sha256").alias("__sha")).distinct()
    again = result.where("kept and doc_id is not null").groupBy("doc_id", F.col("text_sha256").alias("__sha")).agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "__sha")
    few = stored(dropped.unionByName(again).distinct(), "copies")
    # documents whose id has no row to leave out stay as they are; only the texts of the others are shuffled
    some, clean = split_by_keys(docs, F.col("doc_id").cast("long"), few.select("doc_id").distinct())
    keyed = some.withColumn("__sha", F.sha2(normalised(), 256))
    once = keyed.join(few, ["doc_id", "__sha"], "left_anti")
    repeated = keyed.join(again, ["doc_id", "__sha"], "left_semi").dropDuplicates(["doc_id", "__sha"])
    return clean.unionByName(once.unionByName(repeated).select(*all_columns(docs)))
