"""Near copies by exact similarity of word shingles: all pairs whose sets of shingles have a Jaccard index of
``SIMILARITY`` or more, without comparing all pairs.

In any common order of shingles, two sets that similar share one within their leading n - ceil(similarity * n) + 1
(prefix filter), so only documents that meet there are compared, on their whole sets. The order is by the count of a
shingle in a sample of documents, then by hash: it only decides how many pairs are compared, never which are found.
Shingles that no two documents share leave in the one shuffle that all leading shingles take.

First SimHash fingerprints over the same shingles and multi-index hashing (``simhash.links``) fetch candidates, and each
document gets one other that shares most of its leading shingles among the smallest documents of these. All are compared
on their whole sets; what this links is one component. Fingerprints of similar sets often differ in more bits than any
usable radius, so they only begin the search and the prefix filter ends it. Rounds of one comparison with a document of another component follow while
they link anything, and only pairs of components that are still apart remain for the last comparison.
How many leading shingles two sets share bounds how much they can have in common at all, so few pairs are compared.
The last comparison meets a pair at the first leading shingle it shares: where the shingles before are the same on both
sides, or stand too far back for similar sets, it does not. This leaves out no pair, and rows follow pairs, not shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import all_columns, mix64, pieces, raw_bytes, release_shuffles, split_by_keys, stored
from tidemark.llm.simhash import components, fingerprinted, links
from tidemark.llm.words import VISIBLE, Words, grams

SHINGLE = 5
#: Jaccard index from which on documents are near copies, as a fraction.
SIMILARITY = (4, 5)
#: Documents, about, whose shingles are counted, and counts that are broadcast at most; both for the order only.
SAMPLE_DOCS, COUNTED = 5_000, 1 << 17
#: Shingles in so many sampled documents are met in ``SALTS`` groups first.
HOT, SALTS = 16, 64
#: Rounds of one comparison for each document still apart; they only save comparisons of all pairs.
ROUNDS = 6
BATCH_BYTES = 1 << 20


def shingles(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct word shingles of each text, sorted; a shorter text is one shingle."""
    words = Words.of(*raw_bytes(array), VISIBLE)
    hashes, counts, left = words.hashes(), words.counts(), words.until_end()
    at = np.flatnonzero(left >= SHINGLE)
    texts, found = [np.searchsorted(words.first, at, "right") - 1], [grams(hashes, SHINGLE)[at] if len(at) else np.empty(0, np.uint64)]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        if len(short):
            texts.append(short)
            found.append(grams(hashes, size)[words.first[short]])
    text, h = np.concatenate(texts), np.concatenate(found)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


def _prefixes(docs: DataFrame) -> DataFrame:
    """(h, doc_id, n, salt, place): the leading shingles of every document, its number of shingles, and the place in their order."""
    total = max(1, docs.count())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(shingles(batch.column("text"))[1].view(np.int64))], ["h"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, total // SAMPLE_DOCS))) == 0)
    often = sample.select("text").mapInArrow(each, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    often = often.orderBy(F.desc("n"), "h").limit(COUNTED).toPandas().sort_values("h")
    known = docs.sparkSession.sparkContext.broadcast((often["h"].to_numpy(np.int64), often["n"].to_numpy(np.int64)))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = known.value
        for batch in pieces(batches, "text", BATCH_BYTES):
            text, h = shingles(batch.column("text"))
            h = h.view(np.int64)
            count = np.zeros(len(h), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                count = np.where(keys[at] == h, times[at], 0)
            order = np.lexsort((h, count, text))
            text, h, hot = text[order], h[order], (count >= HOT)[order]
            sizes = np.bincount(text, minlength=batch.num_rows)
            place = np.arange(len(text)) - (np.cumsum(sizes) - sizes)[text]
            up, down = SIMILARITY
            front = place < (sizes - -(-up * sizes // down) + 1)[text]
            text, h, hot = text[front], h[front], hot[front]
            ids, place = batch.column("doc_id").to_numpy()[text], place[front].astype(np.int32)
            salt = np.where(hot, 1 + mix64(ids.view(np.uint64)) % np.uint64(SALTS), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids), pa.array(sizes[text].astype(np.int32)), pa.array(salt), pa.array(place)], ["h", "doc_id", "n", "salt", "place"])

    return docs.mapInArrow(lead, "h long, doc_id long, n int, salt int, place int")


def _shared(n: str) -> str:
    """Leading shingles of a set of ``n``, as SQL."""
    up, down = SIMILARITY
    return f"({n} - cast(ceil({up} * {n} / {down}D) as int) + 1)"


def _can_be_similar(n: str, m: str, both: str) -> str:
    """Of similar sets of n and m shingles at least so many leading ones are in common: what is not a leading shingle
    of the set whose leading ones end first adds no more than its own rest."""
    up, down = SIMILARITY
    rest = f"greatest({n} - {_shared(n)}, {m} - {_shared(m)})"
    return f"({down} * {n} >= {up} * {m} AND {down} * {m} >= {up} * {n} AND ({both} + {rest}) * {up + down} >= {up} * ({n} + {m}))"


def _can_be_first(n: str, m: str, place: str, other: str) -> str:
    """A shingle at these places can be the first one that two similar sets of n and m shingles share: what follows
    it, and itself, is all they can have in common."""
    up, down = SIMILARITY
    return f"(least({n} - {place}, {m} - {other}) * {up + down} >= {up} * ({n} + {m}))"


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of doc_ids whose whole sets of shingles are similar."""
    pairs = stored(pairs, "pairs")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            text, h = shingles(batch.column("text"))
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
            sets = [h[a:b].tobytes() for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = SIMILARITY
        for batch in batches:
            similar = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                similar.append(down * both >= up * (len(x) + len(y) - both))
            take = pa.array(np.flatnonzero(similar))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in ("a", "b")], ["a", "b"])

    wanted = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "wanted")
    some, _ = split_by_keys(docs, F.col("doc_id"), wanted)
    sets = stored(some.join(wanted, "doc_id", "left_semi").mapInArrow(whole, "doc_id long, hashes binary"), "shingles")
    left, right = (sets.select(F.col("doc_id").alias(k), F.col("hashes").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return stored(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "similar")


def _merged(joined: DataFrame, near: DataFrame) -> DataFrame:
    """(node, root) with the links ``near`` added: only the roots that these link are searched for components again."""
    left, right = (joined.select(F.col("node").alias(k), F.col("root").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    ends = near.join(left, "a", "left").join(right, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    moved = components(ends.where("a <> b")).select(F.col("node").alias("root"), F.col("root").alias("lower"))
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct().join(joined, "node", "left_anti")
    every = joined.union(nodes.select("node", F.col("node").alias("root")))
    return stored(every.join(moved, "root", "left").select("node", F.coalesce("lower", "root").alias("root")), "joined")


def _named(entries: DataFrame, joined: DataFrame) -> DataFrame:
    """(h, doc_id, n, place, root): the entries with the component of their document, its own id where it has no link."""
    joined = joined.withColumnRenamed("node", "doc_id")
    named = entries.select("h", "doc_id", "n", "place").join(joined, "doc_id", "left")
    return stored(named.select("h", "doc_id", "n", "place", F.coalesce("root", "doc_id").alias("root")), "named")


def _still_apart(named: DataFrame) -> DataFrame:
    """(a, b): every pair of documents of different components that can be similar by its leading shingles, once.

    All that such a pair shares are shingles of several components, so their order among these alone decides which is
    the first. The shingles of a document are then intersected whole.
    """
    mixed = named.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
    before = F.lag("h").over(Window.partitionBy("doc_id").orderBy("place"))
    left = stored(named.join(mixed, "h", "left_semi").withColumn("before", before), "apart")
    right = left.select("h", *(F.col(c).alias(f"_{c}") for c in ("doc_id", "n", "place", "root", "before")))
    up, down = SIMILARITY
    apart = f"doc_id < _doc_id AND root <> _root AND {down} * n >= {up} * _n AND {down} * _n >= {up} * n"
    first = f"(before IS NULL OR _before IS NULL OR before <> _before) AND {_can_be_first('n', '_n', 'place', '_place')}"
    met = left.join(right, "h").where(f"{apart} AND {first}").select(F.col("doc_id").alias("a"), F.col("_doc_id").alias("b")).distinct()
    fronts = left.groupBy("doc_id", "n").agg(F.collect_list("h").alias("front"))
    x, y = (fronts.select(F.col("doc_id").alias(k), F.col("n").alias(size), F.col("front").alias(f)) for k, size, f in (("a", "n", "x"), ("b", "m", "y")))
    counted = met.join(x, "a").join(y, "b").withColumn("both", F.size(F.array_intersect("x", "y")))
    return counted.where(_can_be_similar("n", "m", "both")).select("a", "b")


def _fetched(docs: DataFrame) -> DataFrame:
    """(a, b): what fingerprints fetch. Each document meets the smallest one of its own fingerprint, and these meet where
    their fingerprints are linked. Fingerprint zero, that of texts without words, takes no part."""
    rows = stored(fingerprinted(docs, SHINGLE).where("fp <> 0"), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    own = rows.join(nodes, "fp").where("first < doc_id").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    left, right = (nodes.select(F.col("fp").alias(k), F.col("first").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    between = links(nodes).join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return own.union(between).distinct()


def similar_components(docs: DataFrame) -> DataFrame:
    """(node, root): every doc_id that has a near copy, and the smallest doc_id that near copies reach from it."""
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    group = Window.partitionBy("h", "salt")
    met = _prefixes(docs).withColumn("first", F.min(F.struct("doc_id", "n")).over(group)).withColumn("last", F.max("doc_id").over(group))
    met = met.where("salt > 0 OR first.doc_id < last").select("h", "doc_id", "n", "place", F.col("first.doc_id").alias("first"), F.col("first.n").alias("m"))
    entries = stored(met, "met")
    # the smallest documents of the groups of one hot shingle meet as well
    tops = entries.where("doc_id = first").select("h", "doc_id", "n")
    least = tops.groupBy("h").agg(F.min(F.struct("doc_id", "n")).alias("top"), F.count("*").alias("groups")).where("groups > 1")
    tops = tops.join(least, "h").select("h", "doc_id", "n", F.col("top.doc_id").alias("first"), F.col("top.n").alias("m"))
    stars = entries.drop("place").unionByName(tops).where("first < doc_id").groupBy("doc_id", "n", "first", "m").agg(F.count("*").alias("both"))
    best = stars.where(_can_be_similar("n", "m", "both")).groupBy("doc_id").agg(F.max_by("first", F.struct("both", -F.col("first"))).alias("first"))
    tried = stored(best.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).union(_fetched(docs)).distinct(), "partners")
    joined = components(_verified(docs, tried))
    for _ in range(ROUNDS):
        named = _named(entries, joined)
        release_shuffles(docs.sparkSession)
        # what is still apart is compared with one document of another component, before all such pairs are
        one = F.struct("root", "doc_id", "n")
        sides = named.groupBy("h").agg(F.min(one).alias("low"), F.max(one).alias("high")).where("low.root < high.root")
        other = F.when(F.col("root") == F.col("low.root"), F.col("high")).otherwise(F.col("low"))
        met = named.join(sides, "h").select("doc_id", "n", other.alias("other"))
        met = met.groupBy("doc_id", "n", F.col("other.doc_id").alias("partner"), F.col("other.n").alias("m")).agg(F.count("*").alias("both"))
        met = met.where(_can_be_similar("n", "m", "both")).select("doc_id", "partner", "both", F.least("doc_id", "partner").alias("a"), F.greatest("doc_id", "partner").alias("b"))
        best = met.join(tried, ["a", "b"], "left_anti").groupBy("doc_id").agg(F.max_by("partner", F.struct("both", -F.col("partner"))).alias("partner"))
        pairs = stored(best.select(F.least("doc_id", "partner").alias("a"), F.greatest("doc_id", "partner").alias("b")).distinct(), "partners")
        more = _verified(docs, pairs)
        if more.isEmpty():
            break
        joined, tried = _merged(joined, more), tried.union(pairs)
    else:
        named = _named(entries, joined)
    return _merged(joined, _verified(docs, _still_apart(named)))


def without_similar(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component of near copies, with all columns.

    doc_id identifies a document; rows without one and texts without words stay.
    """
    dropped = stored(similar_components(docs).where("node <> root").select(F.col("node").alias("doc_id")).distinct(), "near-copies")
    some, clean = split_by_keys(docs, F.col("doc_id").cast("long"), dropped)
    return clean.unionByName(some.join(dropped, "doc_id", "left_anti").select(*all_columns(docs)))
