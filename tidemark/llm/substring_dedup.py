"""Removal of repeated substrings by blockwise suffix sorting.

Every ``LENGTH``-byte string has one anchor: the least hash among its ``GRAM``-byte grams. Equal strings have equal
anchors and agree on ``_SIDE`` bytes on one side of it at least. Anchors that no two documents hold with such a side need
no sorting; the others are found by the Golomb-coded exchange, of both sides: sixteen bytes alone meet by chance the
more often the larger the table is.
Neighbouring strings with one anchor form a segment of text, and the segments of an anchor are a suffix bucket
that can be sorted anywhere: each task sorts its buckets block by block with a difference cover, which bounds
memory by the block. Equal segments are combined before the shuffle, so a passage that a third of all
documents share is one row of every task. At the ends of such a passage every document brings a segment of its own
to one anchor: buckets beyond a block are cut into their strings, which meet by their bytes all over the cluster.
Strings themselves are compared, hashes only bring them together.
Copies of a whole text need no search: the one with the smallest doc_id stands for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import RangeFilters, drop_folder, mix64, parallelism, pieces, raw_bytes, release_shuffles, stored, text_or_empty
from tidemark.llm.golomb import by_owner, decode, encode
from tidemark.llm.suffixes import PERIOD, equal_runs
from tidemark.llm.words import rolling
from tidemark.sources.workspace import fresh_folder

LENGTH, GRAM = 50, 16
BATCH_BYTES = 2 << 20
#: Bytes of text whose segments are looked up together where the filter has several parts.
GROUP_BYTES = 16 << 20
#: Bytes of segments in a block, and suffixes in a bucket that is sorted at once.
BLOCK_BYTES, BUCKET_SUFFIXES = 2 << 20, 1 << 18
#: A segment's bytes at most: its anchor lies in all of its strings.
SEGMENT_BYTES = 2 * LENGTH - GRAM
#: Of the bytes beside its anchor a string has so many on one side at least.
_SIDE = (LENGTH - GRAM) // 2
_BASE = 0x9E3779B97F4A7C15 | 1
#: Low bits that hold a position while minima are taken; texts beyond are handled by wider ones.
_PLACE_BITS = 22
#: Bits of a hash that are exchanged.
_SENT_BITS = 48


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    return np.cumprod(np.full(n, np.uint64(_BASE))), np.cumprod(np.full(n, inverse))


def _gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from every position on."""
    powers, inverses = _powers(1 << max(_PLACE_BITS, int(len(data)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)])])
    return mix64((sums[length:] - sums[:-length]) * inverses[: len(sums) - length])


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of starts with one anchor inside a text: first start, last start, place and hash of the anchor."""
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    hashes = _gram_hashes(data, GRAM)
    place = np.uint64((1 << max(_PLACE_BITS, int(len(data)).bit_length())) - 1)
    least = rolling((hashes & ~place) | np.arange(len(hashes), dtype=np.uint64), LENGTH - GRAM + 1, np.minimum)
    anchor = (least & place).astype(np.int64)
    sizes = np.diff(offsets)
    long_enough = np.flatnonzero(sizes >= LENGTH)
    steps = np.zeros(len(data) + 1, np.int32)
    np.add.at(steps, offsets[long_enough], 1)
    np.add.at(steps, offsets[long_enough + 1] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(steps)[: len(anchor)])
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    at = anchor[starts]
    text = np.searchsorted(offsets, starts, "right")
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    return starts[first], starts[np.append(first[1:], len(starts)) - 1], at[first], hashes[at[first]]


def _sides(data: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the left and the right side of the anchors: the segments that have ``_SIDE`` bytes there, and the leading bits
    of a hash of anchor and side. Every string of a segment has one side or both, and so has its segment."""
    if not len(first):
        return [(np.empty(0, np.int64), np.empty(0, np.uint64))] * 2
    hashes, cut = _gram_hashes(data, GRAM + _SIDE), np.uint64(64 - _SENT_BITS)
    left = np.flatnonzero(anchor - first >= _SIDE)
    right = np.flatnonzero(anchor + GRAM + _SIDE <= last + LENGTH)
    return [(left, hashes[anchor[left] - _SIDE] >> cut << cut), (right, mix64(~hashes[anchor[right]]) >> cut << cut)]


def _shared_sides(docs: DataFrame) -> DataFrame:
    """Column h: the leading bits of the hashes of ``_sides`` that occur in two documents or more (and a few others)."""
    owners = parallelism(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids = [], []
        for batch in pieces(batches, "text", BATCH_BYTES):
            data, offsets = raw_bytes(batch.column("text"))
            first, last, anchor, _ = segments(data, offsets)
            doc = batch.column("doc_id").to_numpy()[np.searchsorted(offsets, first, "right") - 1]
            for rows, found in _sides(data, first, last, anchor):
                hashes.append(found)
                ids.append(doc[rows])
        h, doc = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (hashes, ids))
        order = np.lexsort((doc, h))
        h, doc = h[order].astype(np.uint64), doc[order]
        same = h[1:] == h[:-1]
        distinct = np.unique(h)
        repeated = np.unique(h[1:][same & (doc[1:] != doc[:-1])])
        part, rows = TaskContext.get().partitionId(), []
        for kind, values in ((0, distinct), (1, repeated)):
            rows += [(part, kind, owner, encode(own)) for owner, own in by_owner(values, owners)]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["part", "kind", "owner", "blob"])

    def answer(key, table):
        lists = [decode(blob) for blob, kind in zip(table.column("blob").to_pylist(), table.column("kind").to_pylist()) if kind == 0]
        inside = [decode(blob) for blob, kind in zip(table.column("blob").to_pylist(), table.column("kind").to_pylist()) if kind == 1]
        values = np.sort(np.concatenate(lists))
        shared = np.unique(np.concatenate([values[1:][values[1:] == values[:-1]], *inside]))
        return pa.table({"h": shared.view(np.int64)})

    sent = docs.mapInArrow(send, "part int, kind int, owner int, blob binary")
    return stored(sent.groupBy("owner").applyInArrow(answer, "h long"), "sides")


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of about ``size`` bytes of text, one batch at least."""
    held, used = [], 0
    for batch in batches:
        held.append(batch)
        used += int(raw_bytes(batch.column("text"))[1][-1])
        if used >= size:
            yield held
            held, used = [], 0
    if held:
        yield held


def _later_copies(rows: DataFrame) -> DataFrame:
    """The doc_ids all of whose texts also occur under a smaller doc_id."""
    digests = stored(rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha")), "digests")
    first = digests.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = digests.join(first, "sha", "left").groupBy("doc_id").agg(F.bool_and(F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))).alias("copy"))
    return stored(copies.where("copy").select("doc_id"), "copies")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by h in blocks that end where h changes, each closed at the first such place after its bytes."""
    held: list[pa.RecordBatch] = []
    used = 0
    for batch in batches:
        held.append(batch)
        used += int(raw_bytes(batch.column("segment"))[1][-1])
        if used < BLOCK_BYTES:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        ends = raw_bytes(rows.column("segment"))[1]
        h = rows.column("h").to_numpy()
        changes = np.flatnonzero(h[1:] != h[:-1]) + 1
        start = 0
        while (i := int(np.searchsorted(ends[changes], ends[start] + BLOCK_BYTES))) < len(changes):
            yield rows.slice(start, int(changes[i]) - start)
            start = int(changes[i])
        held, used = rows.slice(start).to_batches(), int(ends[-1] - ends[start])
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _meeting(h: np.ndarray, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Which segments may share a string with another of their anchor.

    Such a string holds the anchor and ``_SIDE`` bytes on one side of it, and has them in both segments.
    """
    may = np.zeros(len(h), bool)
    if len(data) < GRAM + _SIDE:
        return may
    hashes = _gram_hashes(data, GRAM + _SIDE)
    for at, there in ((anchor - _SIDE, anchor >= _SIDE), (anchor, anchor + GRAM + _SIDE <= sizes)):
        rows = np.flatnonzero(there)
        _, kind, n = np.unique(mix64(hashes[begins[rows] + at[rows]] + mix64(h[rows].view(np.uint64))), return_inverse=True, return_counts=True)
        may[rows] |= n[kind] > 1
    return may


def _least_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments (h, segment, key, anchor, low, high) sorted by h: for each, the smallest document of every
    string in it.

    One row per segment from which a document may lose something: (h, key, at, least), run-length coded by start.
    """
    names = ["h", "key", "at", "until", "least"]

    def listed(h, key, lengths, *runs) -> pa.RecordBatch:
        bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(key), *(pa.ListArray.from_arrays(bounds, pa.array(r)) for r in runs)], names)

    for rows in _blocks(batches):
        h, key, low, high, anchor = (rows.column(c).to_numpy().astype(np.int64) for c in ("h", "key", "low", "high", "anchor"))
        data, offsets = raw_bytes(rows.column("segment"))
        sizes = np.diff(offsets)
        sort = _meeting(h, data, offsets[:-1], sizes, anchor)
        # the others meet no other string: their own smallest document holds all of theirs
        own = np.flatnonzero(~sort & (low < high))
        yield listed(h[own], key[own], np.ones(len(own), np.int64), np.zeros(len(own), np.int64), sizes[own] - LENGTH + 1, low[own])
        if not sort.any():
            continue
        pick = np.flatnonzero(sort)
        from_, h, key, low, high, sizes = offsets[pick], h[pick], key[pick], low[pick], high[pick], sizes[pick]
        # every segment is followed by its number, so that suffixes differ soon after it
        begins = np.cumsum(sizes + PERIOD) - (sizes + PERIOD)
        text = np.zeros(int((sizes + PERIOD).sum()) + PERIOD, np.uint8)
        for i in range(4):
            text[begins + sizes + i] = np.arange(len(pick)) >> 8 * (3 - i) & 255
        inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text[np.repeat(begins, sizes) + inside] = data[np.repeat(from_, sizes) + inside]
        counts = sizes - LENGTH + 1
        edges = np.concatenate([[0], np.cumsum(counts)])
        starts = np.repeat(begins - edges[:-1], counts) + np.arange(edges[-1])
        owner = np.repeat(np.arange(len(pick)), counts)
        least = low[owner]
        number = np.full(len(text), -1, np.int64)
        number[starts] = np.arange(len(starts))
        for order, new in equal_runs(text, starts, LENGTH, BUCKET_SUFFIXES):
            strings = number[order]
            first = np.flatnonzero(new)
            least[strings] = np.repeat(np.minimum.reduceat(least[strings], first), np.diff(first, append=len(strings)))
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(change)
        runs = np.searchsorted(at, edges)
        keep = np.flatnonzero(np.minimum.reduceat(least, edges[:-1]) < high)
        lengths = np.diff(runs)[keep]
        chosen = np.repeat(runs[keep] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        shift = edges[owner[at[chosen]]]
        yield listed(h[keep], key[keep], lengths, at[chosen] - shift, np.append(at[1:], len(least))[chosen] - shift, least[at[chosen]])


def _crowded_anchors(cuts: DataFrame) -> DataFrame:
    """Column h: the anchors whose distinct segments may not fit a block; only hashes are shuffled."""
    each = cuts.select("h", "key").distinct().groupBy("h").agg(F.count("*").alias("n"))
    return stored(each.where(F.col("n") > BLOCK_BYTES // SEGMENT_BYTES).select("h"), "crowded")


def _least_holders_by_string(distinct: DataFrame) -> DataFrame:
    """What ``_least_holders`` gives, for anchors of any number of segments: equal strings are grouped by Spark.

    A segment has ``LENGTH - GRAM + 1`` strings at most. A string that very many segments hold is combined before
    the shuffle, and on the way back split by the skew join.
    """
    places = F.sequence(F.lit(1), F.length("segment") - (LENGTH - 1))
    strings = distinct.select("h", "key", "low", "high", F.posexplode(F.transform(places, lambda i: F.substring(F.col("segment"), i, F.lit(LENGTH)))).alias("at", "string"))
    held = strings.groupBy("h", "string").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").drop("most")
    # Spark takes exploded rows for as few as the segments: broadcast, they would fill the driver
    lost = strings.join(held.hint("merge"), ["h", "string"]).where("least < high")
    one = F.struct(F.col("at").cast("long").alias("at"), (F.col("at") + 1).cast("long").alias("until"), "least")
    return lost.groupBy("h", "key").agg(F.collect_list(one).alias("runs")).select("h", "key", "runs.at", "runs.until", "runs.least")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, row, spans): byte ranges of each text whose strings also start in a document with a smaller doc_id.

    ``docs`` has doc_id (not null), row (a hash of the text) and text.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "row", "text")
    shared = RangeFilters.build(_shared_sides(docs.select("doc_id", "text")))
    together = GROUP_BYTES if len(shared.filters) > 1 else 0

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(pieces(batches, "text", BATCH_BYTES), together):
            found, sides = [], []
            for batch in group:
                data, offsets = raw_bytes(batch.column("text"))
                found.append((batch, data, offsets, *segments(data, offsets)))
                sides += _sides(data, *found[-1][3:6])
            hits = shared.has_each([h for _, h in sides])
            for i, (batch, data, offsets, first, last, anchor, h) in enumerate(found):
                hit = np.zeros(len(first), bool)
                for (rows, _), has in zip(sides[2 * i : 2 * i + 2], hits[2 * i : 2 * i + 2]):
                    hit[rows[has]] = True
                first, last, anchor, h = first[hit], last[hit], anchor[hit], h[hit]
                text = np.searchsorted(offsets, first, "right") - 1
                whole = data.tobytes()
                cut = pa.array([whole[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist())], pa.binary())
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("row").take(take), pa.array(first - offsets[text]), pa.array((anchor - first).astype(np.int16)), pa.array(h.view(np.int64)), cut], ["doc_id", "row", "start", "anchor", "h", "segment"])

    cuts = texts.mapInArrow(cut_out, "doc_id long, row long, start long, anchor short, h long, segment binary")
    release_shuffles(spark)
    # tables that only this function reads; they are removed, and the shuffles behind them released, as soon as they served
    place, later = fresh_folder(spark, "cut"), fresh_folder(spark, "distinct")
    cuts = stored(cuts.withColumn("key", F.xxhash64("segment")), "segments", "zstd", place)
    crowded = _crowded_anchors(cuts)

    def distinct(how: str) -> DataFrame:
        least = F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("anchor").alias("anchor")
        return cuts.join(crowded, "h", how).groupBy("h", "segment", "key").agg(*least)

    each = stored(distinct("left_anti").select("h", "segment", "low", "high", "key", "anchor"), "calm", "zstd", later)
    crowds = stored(distinct("left_semi"), "crowds", "zstd", later)
    release_shuffles(spark)
    bucketed = each.repartition("h").sortWithinPartitions("h")
    sorted_ = stored(bucketed.mapInArrow(_least_holders, "h long, key long, at array<long>, until array<long>, least array<long>"), "holders", within=place)
    split = stored(_least_holders_by_string(crowds), "strings", within=place)
    found = sorted_.unionByName(split)
    drop_folder(spark, later)
    release_shuffles(spark)
    # a segment is known by the hash of its anchor and its own: a very common one is split by the skew join
    met = cuts.select("doc_id", "row", "start", "h", "key").join(found, ["h", "key"])
    ranges = F.arrays_zip("at", "until", "least")
    lost = F.transform(F.filter(ranges, lambda x: x["least"] < F.col("doc_id")), lambda x: F.struct((F.col("start") + x["at"]).alias("a"), (F.col("start") + x["until"] + (LENGTH - 1)).alias("b")))
    spans = met.select("doc_id", "row", lost.alias("lost")).where(F.size("lost") > 0).groupBy("doc_id", "row").agg(F.flatten(F.collect_list("lost")).alias("spans"))
    spans = stored(spans, "spans", "zstd")
    drop_folder(spark, place)
    release_shuffles(spark)
    return spans


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    A byte goes when a ``LENGTH``-byte string over it also starts in a document with a smaller doc_id. Reads
    ``doc_id`` and ``text`` only; a null text is empty. Rows without doc_id neither lose bytes nor take them from
    others; rows with the same doc_id are no smaller than each other. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).withColumn("row", F.xxhash64("text"))
    known = rows.where("doc_id IS NOT NULL").select("doc_id", "row", "text")
    copies = _later_copies(known)
    spans = repeated_spans(known.join(copies, "doc_id", "left_anti"))
    whole = copies.withColumn("copy", F.lit(True))
    joined = rows.join(whole, "doc_id", "left").join(spans, ["doc_id", "row"], "left")
    joined = joined.select("doc_id", "text", F.col("spans.a").alias("a"), F.col("spans.b").alias("b"), F.col("copy").isNotNull().alias("copy"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            data, offsets = raw_bytes(batch.column("text"))
            out = []
            for i, (a, b, copy) in enumerate(zip(batch.column("a"), batch.column("b"), batch.column("copy").to_pylist())):
                text = data[offsets[i] : offsets[i + 1]]
                removed = runs = 0
                if copy and len(text) >= LENGTH:
                    removed, runs, text = len(text), 1, text[:0]
                elif a.is_valid:
                    steps = np.zeros(len(text) + 1, np.int32)
                    np.add.at(steps, a.values.to_numpy(), 1)
                    np.add.at(steps, b.values.to_numpy(), -1)
                    gone = np.cumsum(steps)[:-1] > 0
                    removed, runs = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    text = text[~gone]
                kept = text.tobytes()
                out.append((len(kept) + removed, removed, runs, hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
