"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (what line feeds separate, empty ones included). Every paragraph is hashed
to a wide vector: four uniform 64-bit lanes, and 256 lanes of 16 bits that add up +1 or -1 for each run of some four
words in it. A fingerprint is the sum of the paragraphs' vectors modulo 2^64 and 2^16. So it does not depend on
their order, equal multisets have equal fingerprints and (but for collisions of 256 bits) only they; paragraphs are
inserted and deleted by adding and subtracting, without the text. The signed lanes also measure likeness: the squared
length of the difference of two fingerprints estimates how many runs only one of them has.

A fingerprint is 1,088 lower-case hex digits: the uniform lanes, then the signed ones, all little-endian.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, parallelism, pieces, text_or_empty
from tidemark.llm.words import VISIBLE, Words

LANES, SIGNED = 4, 256
BATCH_BYTES = 1 << 20
#: Longer texts are summed up from parts cut at line feeds; a single paragraph takes some thirty times its size.
PART_BYTES = 1 << 22
#: A run ends after a word whose hash is 0 modulo this.
RUN = 4
#: Ranges of documents for each partition of a shuffle, and keys looked at for each range.
RANGES, LOOKS = 2, 8
#: Paragraph edits that a task adds up before it sends their sums on.
EDITED_DOCS = 4096
_SPREAD = np.array([sum((v >> t & 1) << 8 * t for t in range(8)) for v in range(256)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
Prints = tuple[np.ndarray, np.ndarray]


def _parts(texts: list[bytes]) -> tuple[list[bytes], list[int]]:
    """Texts cut at line feeds into parts of bounded length where paragraphs allow, and whose part each is."""
    out, owner = [], []
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > PART_BYTES and (cut := text.find(b"\n", start + PART_BYTES)) >= 0:
            out.append(text[start:cut])
            owner.append(i)
            start = cut + 1
        out.append(text[start:])
        owner.append(i)
    return out, owner


def _uniform(texts: list[bytes]) -> np.ndarray:
    split = [text.split(b"\n") for text in texts]
    digests = b"".join([blake2b(p, digest_size=8 * LANES).digest() for paragraphs in split for p in paragraphs])
    counts = np.array([len(p) for p in split])
    return np.add.reduceat(np.frombuffer(digests, "<u8").reshape(-1, LANES), np.cumsum(counts) - counts, axis=0)


def _signed(texts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    words = Words.of(data, offsets, VISIBLE)
    out = np.zeros((len(texts), SIGNED), np.int64)
    n = len(words.starts)
    if not n:
        return out.astype(np.uint16)
    hashes = words.hashes()
    line = np.cumsum(data == 10)[words.starts]
    ends = hashes % np.uint64(RUN) == 0
    ends[:-1] |= line[1:] != line[:-1]
    ends[words.first[1:][words.counts() > 0] - 1] = True
    closes = np.flatnonzero(ends)
    opens = np.concatenate([[0], closes[:-1] + 1])
    place = np.arange(n) - np.repeat(opens, closes - opens + 1)
    runs = np.add.reduceat(mix64(hashes + (place.astype(np.uint64) + np.uint64(1)) * _STEP), opens)
    first = np.searchsorted(opens, words.first)
    counts = np.diff(first)
    full = np.flatnonzero(counts)
    # byte-wide counters hold sums of up to 255 runs: longer texts are added up from several
    parts = -(-counts[full] // 255)
    begin = np.repeat(first[full], parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    text = np.cumsum(parts) - parts
    for s in range(SIGNED // 64):
        octets = mix64(runs + np.uint64((2 * s + 1) * int(_STEP) % (1 << 64))).astype("<u8").view(np.uint8).reshape(-1, 8)
        sums = np.add.reduceat(_SPREAD[octets], begin, axis=0).astype("<u8").view(np.uint8).reshape(len(begin), 64)
        out[full, 64 * s : 64 * s + 64] = 2 * np.add.reduceat(sums.astype(np.int64), text, axis=0) - counts[full, None]
    return out.astype(np.uint16)


def prints_of(texts: list[bytes]) -> Prints:
    """Uniform and signed lanes of each text."""
    if not texts:
        return np.zeros((0, LANES), np.uint64), np.zeros((0, SIGNED), np.uint16)
    parts, owner = _parts(texts)
    uniform, signed = _uniform(parts), _signed(parts)
    if len(parts) == len(texts):
        return uniform, signed
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    return np.add.reduceat(uniform, first, axis=0), np.add.reduceat(signed, first, axis=0)


def to_hex(prints: Prints) -> list[str]:
    uniform, signed = prints
    return [u.tobytes().hex() + s.tobytes().hex() for u, s in zip(uniform.astype("<u8"), signed.astype("<u2"))]


def from_hex(texts: list[str]) -> Prints:
    raw = np.frombuffer(bytes.fromhex("".join(texts)), np.uint8).reshape(len(texts), 8 * LANES + 2 * SIGNED)
    return raw[:, : 8 * LANES].copy().view("<u8"), raw[:, 8 * LANES :].copy().view("<u2")


def likeness(a: Prints, b: Prints) -> np.ndarray:
    """For each pair of fingerprints 1 if they are equal, else about the share of runs in common (0 to 1)."""
    lengths = [np.square(x[1].view(np.int16).astype(np.float64)).sum(axis=1) for x in (a, b)]
    apart = np.square((a[1] - b[1]).view(np.int16).astype(np.float64)).sum(axis=1)
    total = lengths[0] + lengths[1]
    alike = np.clip(1 - apart / np.where(total > 0, total, 1), 0, 1)
    equal = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(equal, 1.0, np.where(total > 0, alike, 0.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; reads ``doc_id`` and ``text`` only, a null text is empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(to_hex(prints_of(texts)), pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(hashed, "doc_id long, fingerprint string")


def updated(prints: DataFrame, edits: DataFrame) -> DataFrame:
    """Fingerprints (doc_id, fingerprint) after ``edits`` (doc_id, paragraph, n): n copies of a paragraph inserted,
    or deleted where n is negative. No text is read.

    doc_id identifies a fingerprint. Edits of documents without a fingerprint start from the empty sum; null
    paragraphs are empty, null counts 0, rows without doc_id are left out. Tasks add up the edits of a document
    before they are shuffled, so a document with a third of all edits sends one sum per 4,096 documents of a task.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out() -> pa.RecordBatch:
            sums = (np.array([v[0] for v in held.values()]).reshape(-1, LANES), np.array([v[1] for v in held.values()]).reshape(-1, SIGNED))
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(to_hex(sums), pa.string())], ["doc_id", "fingerprint"])

        for batch in pieces(batches, "paragraph", BATCH_BYTES):
            uniform, signed = prints_of([p.encode() for p in batch.column("paragraph").to_pylist()])
            times = batch.column("n").to_numpy()
            uniform, signed = uniform * times.view(np.uint64)[:, None], signed * times.astype(np.uint16)[:, None]
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                if doc in held:
                    held[doc][0] += uniform[i]
                    held[doc][1] += signed[i]
                else:
                    held[doc] = [uniform[i].copy(), signed[i].copy()]
            if len(held) > EDITED_DOCS:
                yield out()
                held.clear()
        if held:
            yield out()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        uniform, signed = from_hex(list(group["fingerprint"]))
        whole = uniform.sum(axis=0, dtype=np.uint64)[None], signed.sum(axis=0, dtype=np.uint16)[None]
        return pd.DataFrame({"doc_id": group["doc_id"].iloc[:1], "fingerprint": to_hex(whole)})

    rows = edits.select(F.col("doc_id").cast("long"), text_or_empty("paragraph").alias("paragraph"), F.coalesce(F.col("n").cast("long"), F.lit(0)).alias("n"))
    kind = "doc_id long, fingerprint string"
    parts = rows.where("doc_id is not null").mapInArrow(summed, kind)
    known = prints.select(F.col("doc_id").cast("long"), F.col("fingerprint").cast("string"))
    changed = parts.unionByName(known.join(parts.select("doc_id").distinct(), "doc_id", "left_semi")).groupBy("doc_id").applyInPandas(add, kind)
    return known.join(parts.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(changed)


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with a binary ``key``: its ascending order is that of descending doc_id, nulls last, ties by text."""
    big_endian = F.unhex(F.lpad(F.hex(F.bitwise_not("doc_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    known = F.concat(F.unhex(F.lit("00")), big_endian)
    return rows.withColumn("key", F.concat(F.coalesce(known, F.unhex(F.lit("01"))), F.unhex(F.sha2("text", 256))))


def _edges(rows: DataFrame, ranges: int) -> list[bytes]:
    """The first of all keys, and keys of rows that cut the others into about ``ranges`` even ranges."""
    top, total = rows.agg(F.max("doc_id"), F.count("*")).first()
    if not total:
        return []
    first = _ordered(rows.where(F.col("doc_id").eqNullSafe(F.lit(top).cast("long")))).agg(F.min("key")).first()[0]
    scale = 1 << 30
    share = min(scale, -(-scale * ranges * LOOKS // total))
    looked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share)
    keys = sorted(bytes(r["key"]) for r in _ordered(looked).select("key").distinct().collect())
    return sorted({bytes(first), *keys[LOOKS - 1 :: LOOKS]})


def edited_likeness(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document in descending order of doc_id; the first one follows the last. Reads ``doc_id`` and ``text`` only; a null
    text is empty. Rows without doc_id come last, ties follow by the SHA-256 of their texts, so equal rows are
    interchangeable; a single row is its own next one. An empty table gives an empty result.

    Texts are shuffled once, by ranges of the order; the first row of each range also goes to the range before, so
    that every row meets its next one there. Rows equal in doc_id and text meet in one range and are streamed.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
    edges = _edges(rows, RANGES * parallelism(spark))
    held = spark.sparkContext.broadcast(edges)

    @F.pandas_udf("array<struct<span: int, follower: boolean>>")
    def spans(keys: pd.Series) -> pd.Series:
        cuts = held.value
        out = []
        for key in map(bytes, keys):
            own = bisect_right(cuts, key) - 1
            out.append([(own, False), ((own - 1) % len(cuts), True)] if cuts[own] == key else [(own, False)])
        return pd.Series(out)

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    columns = ["span", "follower", "doc_id", "text"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.RecordBatch | None = None
        for batch in pieces(batches, "text", BATCH_BYTES):
            batch = batch.select(columns)
            if before is not None:
                batch = pa.concat_batches([before, batch])
            before = batch.slice(batch.num_rows - 1)
            texts = batch.column("text").to_pylist()
            follower = batch.column("follower").to_numpy(zero_copy_only=False)
            at = np.flatnonzero(~follower[:-1])
            if not len(at):
                continue
            edited = []
            for i in at.tolist():
                half = len(texts[i]) // 2
                edited.append((texts[i][: len(texts[i]) - half] + texts[i + 1][:half]).encode())
            own, other = prints_of([t.encode() for t in texts]), prints_of(edited)
            mine = own[0][at], own[1][at]
            then = own[0][at + 1], own[1][at + 1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at)),
                    pa.array([len(texts[i]) for i in at.tolist()], pa.int64()),
                    pa.array([sha256(e).hexdigest() for e in edited], pa.string()),
                    pa.array(to_hex(mine), pa.string()),
                    pa.array(to_hex(other), pa.string()),
                    pa.array(likeness(mine, other)),
                    pa.array(likeness(mine, then)),
                ],
                schema=schema,
            )

    dealt = _ordered(rows).withColumn("at", F.explode(spans("key"))).select("at.span", "at.follower", "doc_id", "text", "key")
    placed = dealt.repartition(parallelism(spark), "span").sortWithinPartitions("span", "follower", "key").select(*columns)
    return placed.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
