"""Near duplicates by SimHash fingerprints and multi-index hashing.

Equal fingerprints are one node. A fingerprint is cut into two segments of 32 bits; two fingerprints that differ
in at most two bits differ in at most one bit of the first or in none of the second. So each one looks up the
Hamming ball of radius 1 around its first segment in a table of first segments, and its second segment in a
table of second ones; what is fetched is verified on all 64 bits. A fingerprint whose segment is shared by more
than ``CROWD`` others leaves these tables: it looks up its whole Hamming ball of radius 2 in the table of all
fingerprints instead, so a crowded entry never becomes all its pairs and no link is lost. Links become components
by large-star / small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import all_columns, pieces, raw_bytes, release_shuffles, stored, unsigned_hex
from tidemark.llm.words import VISIBLE, Words

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints that share a segment at most before its holders look up whole fingerprints (2,081 each).
CROWD = 512
BATCH_BYTES = 1 << 20
_SPREAD = np.array([sum((v >> t & 1) << 8 * t for t in range(8)) for v in range(256)], np.uint64)


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the bits set in over half of its hashes; ``first`` has each text's first hash and the end."""
    counts = np.diff(first)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # byte-wide counters hold sums of up to 255 hashes: longer texts are added up from several
    parts = -(-counts[full] // 255)
    begin = np.repeat(first[full], parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    text = np.cumsum(parts) - parts
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for b in range(8):
        sums = np.add.reduceat(_SPREAD[octets[:, b]], begin).astype("<u8").view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(sums.astype(np.int64), text, axis=0)
        for t in range(8):
            out[full] |= (2 * totals[:, t] > counts[full]).astype(np.uint64) << np.uint64(8 * b + t)
    return out


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text over its shingles of ``size`` words."""
    words = Words.of(data, offsets, VISIBLE)
    lengths = words.ends - words.starts
    places = np.cumsum(lengths + 1) - (lengths + 1)  # every word followed by one space
    joined = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[np.repeat(places, lengths) + inside] = words.data[np.repeat(words.starts, lengths) + inside]
    counts = words.counts()
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(shingles)])
    opens = np.repeat(words.first[:-1], shingles) + np.arange(first[-1]) - np.repeat(first[:-1], shingles)
    closes = opens + np.repeat(np.minimum(counts, size), shingles) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(places[opens].tolist(), (places[closes] + lengths[closes]).tolist())
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in spans), np.uint64, int(first[-1]))
    return _majority(hashes, first)


def fingerprinted(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row, over shingles of ``size`` words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            found = fingerprints_of(*raw_bytes(batch.column("text")), size)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(hashed, "doc_id long, fp long")


def _ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits, as signed 64-bit values."""
    masks = [sum(1 << i for i in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct values in ``fp`` that differ in at most ``RADIUS`` bits.

    Spark takes rows after an explode for no larger than before it, so what looks up a ball (33 or 2,081 rows for one) is
    joined by sorting: it would be broadcast while the table it comes from is below the limit.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)
    keyed = nodes.select("fp", high.alias("high"), low.alias("low"))
    crowded = [keyed.groupBy(k).agg(F.count("*").alias("n")).where(f"n > {CROWD}").select(k) for k in ("high", "low")]
    busy = keyed.join(crowded[0], "high", "left_semi").select("fp").union(keyed.join(crowded[1], "low", "left_semi").select("fp"))
    busy = stored(busy.distinct(), "crowded")
    calm = stored(keyed.join(busy, "fp", "left_anti"), "segments")
    pair = [F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")]
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS
    array = lambda masks: F.explode(F.array(*map(F.lit, masks)))
    around = calm.select("fp", "high", array(_ball(32, 1)).alias("mask")).select("fp", F.col("high").bitwiseXOR(F.col("mask")).alias("key"))
    firsts = around.hint("merge").join(calm.select(F.col("fp").alias("other"), F.col("high").alias("key")), "key")
    seconds = calm.select("fp", F.col("low").alias("key")).join(calm.select(F.col("fp").alias("other"), F.col("low").alias("key")), "key")
    tables = firsts.select("fp", "other").union(seconds.select("fp", "other")).where(close)
    whole = busy.select("fp", array(_ball(64, RADIUS)).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("other"))
    whole = whole.hint("merge").join(nodes.select(F.col("fp").alias("other")), "other").select("fp", "other")
    return tables.union(whole).where("fp <> other").select(*pair).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct edges (a, b) is a centre a or hangs on one centre alone."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("hung")).union(edges.select("b", F.lit(1)))
    sides = ends.groupBy("node").agg(F.min("hung").alias("low"), F.sum("hung").alias("times"))
    return sides.where("times > 1 OR times > low").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the smallest node it reaches.

    Every round hangs larger neighbours on the smallest one (large star), then the rest of a node's smaller
    neighbours (small star), until the edges are stars. Each round is stored, so that none is computed again, and the
    driver gives back what the one before left.
    """

    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(edges):
        release_shuffles(edges.sparkSession)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "stars")
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        large = stored(large, "links")
        least = stored(large.groupBy("b").agg(F.min("a").alias("m")), "stars")
        hung = large.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).where("x <> y").union(least.select("m", "b"))
        edges = stored(hung.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select("a", "a").distinct())


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Reads ``doc_id`` and ``text`` only. Null, empty and blank texts have fingerprint zero and are linked like any
    other; repeated rows fall together. component_id is null only where a whole component lacks doc_ids.
    """
    rows = stored(fingerprinted(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    joined = components(links(nodes)).withColumnRenamed("node", "fp")
    linked = stored(nodes.join(joined, "fp"), "members")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    renamed = linked.join(smallest, "root").select("fp", "component_id")
    alone = nodes.join(joined.select("fp"), "fp", "left_anti").select("fp", F.col("first").alias("component_id"))
    # every fingerprint has one row here; a fingerprint of very many rows is split by the adaptive skew join
    named = stored(renamed.union(alone), "named")
    return rows.join(named, "fp").select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component, with all columns.

    doc_id identifies a document; rows without one stay.
    """
    dropped = stored(near_groups(docs).where("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    return docs.join(dropped, "doc_id", "left_anti").select(*all_columns(docs))
