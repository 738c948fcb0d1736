"""Packing into fixed-length training sequences as a cutting-stock problem.

Documents are cut into full sequences and one remainder each; the histogram of piece lengths (``CLASSES``
classes whatever the corpus size) is all the driver sees. A linear program over patterns of lengths is solved by
column generation: the simplex basis holds patterns, its duals price the lengths, and a knapsack dynamic
program finds the pattern worth most. Rounded-down pattern counts, and first-fit sequences for the few pieces
left, become ranges of ranks in each length class; ranked pieces look up their sequence there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parallelism, pieces, stored
from tidemark.llm.tokens import encode

LENGTH = 2048
#: Tokens per length class: a piece of n tokens takes ceil(n / QUANTUM) units.
QUANTUM = 16
END = 1
#: The LP ends when no pattern is worth more than this many sequences: it is then within that factor of its optimum.
TOLERANCE = 1.0005
BATCH_BYTES = 1 << 21
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _price(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: unbounded knapsack over capacity units."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fits[room]:
            values = best[room - sizes[:n]] + worth[:n]
            i = int(values.argmax())
            if values[i] > best[room] + 1e-12:
                best[room], taken[room] = values[i], i
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= int(sizes[taken[room]])
    return float(best[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(copies, pattern) lists that place every piece: ``demand[i]`` pieces of ``sizes[i]`` units."""
    m = len(sizes)
    if not m:
        return []
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / basis.diagonal())
    # unequal shares of a piece more keep the simplex from cycling; rounding down removes them again
    copies = inverse @ (demand + np.linspace(1e-5, 1e-4, m))
    for _ in range(20 * m):
        value, column = _price(sizes, inverse.sum(axis=0), capacity)
        if value <= TOLERANCE:
            break
        step = inverse @ column
        rising = step > 1e-9
        leaving = int(np.where(rising, copies / np.where(rising, step, 1.0), np.inf).argmin())
        amount = copies[leaving] / step[leaving]
        copies -= amount * step
        copies[leaving] = amount
        inverse[leaving] /= step[leaving]
        step[leaving] = 0.0
        inverse -= np.outer(step, inverse[leaving])
        basis[:, leaving] = column
    rounded = np.floor(np.maximum(copies, 0) + 1e-7).astype(np.int64)
    left = demand - (basis @ rounded).astype(np.int64)
    for i in np.flatnonzero(left < 0):  # rounding noise: give back patterns that hold too many of a length
        for j in np.flatnonzero(basis[i]):
            while left[i] < 0 and rounded[j] > 0:
                rounded[j] -= 1
                left += basis[:, j].astype(np.int64)
    plan = [(int(n), basis[:, j].astype(np.int64)) for j, n in enumerate(rounded) if n]
    open_rows: list[tuple[int, np.ndarray]] = []
    for i in reversed(range(m)):  # the few pieces left: longest first, into the fullest sequence with room
        for _ in range(int(left[i])):
            fitting = [k for k, (room, _) in enumerate(open_rows) if room >= sizes[i]]
            k = min(fitting, key=lambda k: open_rows[k][0]) if fitting else len(open_rows)
            if not fitting:
                open_rows.append((capacity, np.zeros(m, np.int64)))
            open_rows[k][1][i] += 1
            open_rows[k] = (open_rows[k][0] - int(sizes[i]), open_rows[k][1])
    return plan + [(1, pattern) for _, pattern in open_rows]


@dataclass(frozen=True)
class Layout:
    """Ranges of ranks per length class: from ``begin`` on, ``slots`` ranks each go to one sequence after ``base``."""

    key: np.ndarray  # class and first rank, ascending
    begin: np.ndarray
    slots: np.ndarray
    base: np.ndarray

    @staticmethod
    def of(sizes: np.ndarray, plan: list[tuple[int, np.ndarray]]) -> Layout:
        used, base, rows = np.zeros(len(sizes), np.int64), 0, []
        for copies, pattern in plan:
            for i in np.flatnonzero(pattern):
                rows.append((int(sizes[i]), int(used[i]), int(pattern[i]), base))
                used[i] += copies * int(pattern[i])
            base += copies
        rows.sort()
        columns = [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.empty(0, np.int64)] * 4
        return Layout((columns[0] << 48) + columns[1], *columns[1:])

    def sequence(self, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.key, (size << 48) + rank, "right") - 1
        return self.base[at] + (rank - self.begin[at]) // self.slots[at]


def token_pieces(docs: DataFrame, length: int = LENGTH, folder: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document, full ones and a remainder; with ``keep_ids`` also their ids."""
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * keep_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            ids, offsets = encode(batch.column("text"), folder)
            out: list[list] = [[] for _ in names]
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[offsets[i] : offsets[i + 1]], END).astype("<u4")
                for start in range(0, len(own), length):
                    piece = own[start : start + length]
                    row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(own), *[piece.astype(np.int32)] * keep_ids)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    kind = PIECE + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, kind)


def pack(docs: DataFrame, length: int = LENGTH, folder: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Every document ends with id 1, so an empty or null text is one piece of one token. Reads ``doc_id`` and
    ``text`` only. Repeated rows are packed once each; a null doc_id is kept. An empty table gives no pieces.
    Sequences are shorter than ``length`` only by the rounding of their pieces to ``QUANTUM`` tokens and, in a
    bounded number of last sequences, by what was left. ``folder`` holds the vocabulary files.
    """
    spark = docs.sparkSession
    capacity = -(-length // QUANTUM)
    chunks = parallelism(spark)
    rows = token_pieces(docs, length, folder, keep_ids)
    rows = rows.withColumn("size", F.ceil(F.col("length") / QUANTUM).cast("long")).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start"), F.lit(chunks)))
    rows = stored(rows, "pieces")
    counts = stored(rows.groupBy("size", "chunk").count(), "lengths")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("count").alias("n")).collect()}  # one row per class
    sizes = np.array(sorted(histogram), np.int64)
    layout = spark.sparkContext.broadcast(Layout.of(sizes, solve(sizes, np.array([histogram[s] for s in sizes.tolist()], np.int64), capacity)))
    before = F.sum("count").over(Window.partitionBy("size").orderBy("chunk")) - F.col("count")
    offsets = counts.select("size", "chunk", before.alias("before"))
    local = F.row_number().over(Window.partitionBy("size", "chunk").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = rows.withColumn("local", local).join(offsets, ["size", "chunk"]).withColumn("rank", F.col("before") + F.col("local")).drop("before", "local", "chunk")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence = layout.value.sequence(batch.column("size").to_numpy(), batch.column("rank").to_numpy())
            yield batch.append_column("sequence_id", pa.array(sequence))

    kind = f"size long, {PIECE}" + ", ids array<int>" * keep_ids + ", rank long, sequence_id long"
    columns = [c.strip().split()[0] for c in kind.split(",")][:-1]
    placed = ranked.select(*columns).mapInArrow(place, kind)
    ordered = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank")
    offset = F.sum("length").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return placed.withColumn("offset", offset).drop("size", "rank")
