"""Benchmark decontamination by winnowing.

Of the k-gram hashes in every sliding window of words both sides keep the minimum, so two texts that share a
full window (``WINDOW`` words, or a whole shorter item) keep the same k-gram inside it: no shared span is missed.
Document fingerprints meet the benchmark's in a bounded bitmap; a hit is extended to every window around it,
and windows are joined with the benchmark's by their words themselves, so nothing false remains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import KeyFilter, mix64, pieces, raw_bytes, stored
from tidemark.llm.words import ALNUM, Words, grams, rolling

WINDOW = 13
GRAM = 5
#: Working memory of a task is some fifty times this many bytes of text.
BATCH_BYTES = 1 << 20


def _tagged(hashes: np.ndarray, size: int) -> np.ndarray:
    return mix64(hashes ^ np.uint64(size * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))


def fingerprints(words: np.ndarray, left: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed (word position, hash) for windows of ``size`` words that end inside their text."""
    k = min(GRAM, size)
    if len(words) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = np.maximum(_tagged(grams(words, k), size), np.uint64(1))
    least = rolling(hashes, size - k + 1, np.minimum)
    least = np.where(left[: len(least)] >= size, least, np.uint64(0))
    # a hash is kept where it is the minimum of some window over it; 0 stands for windows that leave their text
    edge = np.zeros(size - k, np.uint64)
    kept = np.flatnonzero(rolling(np.concatenate([edge, least, edge]), size - k + 1, np.maximum) == hashes)
    return kept, hashes[kept]


def _benchmark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, h, item, words): fingerprints have null words, windows have theirs."""
    for batch in pieces(batches, "text", BATCH_BYTES):
        data, offsets = raw_bytes(batch.column("text"))
        found = Words.of(data, offsets, ALNUM)
        hashes, rows = found.hashes(), []
        for i, item in enumerate(batch.column("item_id").to_pylist()):
            own = hashes[found.first[i] : found.first[i + 1]]
            size = min(WINDOW, len(own))
            if size:
                left = len(own) - np.arange(len(own))
                rows += [(size, h, item, None) for h in fingerprints(own, left, size)[1].tolist()]
                whole = _tagged(grams(own, size), size).tolist()
                rows += [(size, h, item, found.text(int(found.first[i]) + j, size)) for j, h in enumerate(whole)]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(np.array(columns[1], np.uint64).view(np.int64)), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.binary())], ["size", "h", "item", "words"])


def contamination(docs: DataFrame, benchmark: DataFrame, *extra: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    ``items`` are the ids of the occurring items, sorted as strings; ``spans`` the (word, words) windows hit;
    ``extra`` may ask for ``row``, a hash of the text.
    Reads ``doc_id``, ``text``, ``item_id`` and ``text`` only. A null text has no words; a null item_id reads as
    an empty string; repeated rows get a row each. Empty tables on either side give no hits.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string"))
    known = stored(items.mapInArrow(_benchmark_rows, "size int, h long, item string, words binary"), "benchmark")
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # 1 to WINDOW
    broadcast = docs.sparkSession.sparkContext.broadcast
    marks, windows = (broadcast(KeyFilter.build(known.where(f"words IS {kind} NULL").select("h").distinct())) for kind in ("", "NOT"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, row, n_words) for every document, and (doc_id, row, h, size, start, words) for windows that may match."""
        for batch in pieces(batches, "text", BATCH_BYTES):
            data, offsets = raw_bytes(batch.column("text"))
            found = Words.of(data, offsets, ALNUM)
            hashes, left, counts = found.hashes(), found.until_end(), found.counts()
            ids, rows = batch.column("doc_id"), batch.column("row")
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([ids, rows, pa.array(counts.astype(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names)
            for size in sizes:
                at, marked = fingerprints(hashes, left, size)
                at = at[marks.value.has(marked)]
                around = np.unique((at[:, None] - np.arange(size - min(GRAM, size) + 1)).ravel())
                around = around[(around >= 0) & (around < len(left))]
                around = around[left[around] >= size]
                if not len(around):
                    continue
                own = _tagged(grams(hashes, size), size)[around]
                hit = windows.value.has(own)
                around, own = around[hit], own[hit]
                doc = np.searchsorted(found.first, around, "right") - 1
                take = pa.array(doc)
                text = pa.array([found.text(int(w), size) for w in around], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.take(take), rows.take(take), pa.nulls(len(doc), pa.int64()), pa.array(own.view(np.int64)), pa.array(np.full(len(doc), size, np.int32)), pa.array(around - found.first[doc]), text], names)

    names = ["doc_id", "row", "n_words", "h", "size", "start", "words"]
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("row"), F.col("text").cast("string"))
    found = stored(texts.mapInArrow(candidates, "doc_id long, row long, n_words long, h long, size int, start long, words binary"), "candidates")
    owners = known.where("words IS NOT NULL").groupBy("h", "size", "words").agg(F.collect_set("item").alias("items"))
    hits = found.where("h IS NOT NULL").select("doc_id", "row", "h", "size", "start", "words").join(owners, ["h", "size", "words"])
    spans = hits.groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_set(F.struct("start", F.col("size").cast("long").alias("words")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    rows = found.where("n_words IS NOT NULL").groupBy("doc_id", "row", "n_words").agg(F.count("*").alias("copies"))
    same = rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["row"] == spans["row"])
    joined = rows.join(spans, same, "left").select(rows["doc_id"], rows["row"], "n_words", "copies", "spans", "items")
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))

    def cover(done, span):
        end = span["start"] + span["words"]
        gain = F.greatest(F.lit(0), end - F.greatest(done["end"], span["start"]))
        return F.struct(F.greatest(done["end"], end).alias("end"), (done["hit"] + gain).alias("hit"))

    empty = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    n_hit = F.coalesce(F.aggregate("spans", empty, cover)["hit"], F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    result = joined.select("doc_id", "row", "n_words", n_hit.alias("n_hit"), items.alias("items"), "spans")
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        F.expr("n_hit > 0 AND 20 * n_hit >= n_words").alias("contaminated"), "items", "spans", *extra,
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all columns. Rows are told apart by doc_id and text."""
    bad = contamination(docs, benchmark, "row").where("contaminated").select("doc_id", F.col("row").alias("__row")).distinct()
    bad = stored(bad, "contaminated")
    keyed = docs.withColumn("__row", F.xxhash64(F.col("text").cast("string")))
    same = keyed["doc_id"].eqNullSafe(bad["doc_id"]) & (keyed["__row"] == bad["__row"])
    return keyed.join(bad, same, "left_anti").drop("__row")
