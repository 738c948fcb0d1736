"""Hard negatives of anchors by a BOND vertical scan.

Vectors are held in blocks by dimension, sorted by label. An anchor reads a block's dimensions in the order of its own
descending magnitudes and adds up partial inner products; the block's smallest and largest values bound what the unread
dimensions can still add, so after every few dimensions the candidates that cannot matter any more leave the bitmap.
A first scan keeps the best vectors of the anchor's own label (its positives), a second one those of other labels whose
scores lie in the window of a positive. Tasks keep the best few of all their blocks, whose scores raise the bounds for
the blocks that follow; the few of all tasks are ranked by a shuffle of at most (anchors x kept x tasks) narrow rows.

Anchors meet all rows in blocks: a bounded group of anchors at a time is sent to the tasks that read the vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parallelism, stored
from tidemark.sources.workspace import fresh_folder

#: Rows of a block at most, and bytes of its columns (one row at least).
BLOCK_ROWS, BLOCK_BYTES = 8192, 1 << 24
#: Bytes of the anchors of one pass, about: they are sent to every task.
ANCHOR_BYTES = 1 << 24
#: Dimensions read between two looks at the bounds.
STRIDE = 8
#: Larger quantised components count as this.
LARGEST = 1 << 26


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, q) of the rows (vec_id, label, embedding) that take part: q holds floor(scale * x) as integers.

    Rows with a null id or label, a null vector, or a null or non-finite component are left out; quantised components
    beyond 2^26 count as 2^26 (with their sign), so that scores of vectors of up to 2,048 dimensions fit a long. Rows
    of one vec_id count once: that with the smallest label, then the smallest vector.
    """
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(values, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), scale * x))))).cast("int"))
    kept = rows.where("vec_id is not null and label is not null and embedding is not null").where(finite)
    kept = kept.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), whole.alias("q"))
    return kept.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row")).select("vec_id", "row.label", "row.q")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows of a matrix, short ones filled up with zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == dims).all():
        return values.reshape(len(column), dims)
    out = np.zeros((len(column), dims), values.dtype)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


@dataclass(frozen=True)
class Block:
    """Vectors by dimension, sorted by label; scores are exact in the type of ``columns``."""

    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, largest: int) -> Block:
        """``largest`` bounds the components of the vectors to be compared with."""
        order = np.lexsort((ids, labels))
        columns = rows[order].T
        reach = (int(np.abs(columns.astype(np.int64)).max(initial=0)) + 1) * (largest + 1) * max(1, len(columns))
        # whole numbers below 2^53 are exact as doubles, whose products are fast
        columns = np.ascontiguousarray(columns, np.float64 if reach < 1 << 53 else np.int64)
        return Block(ids[order], labels[order], columns, columns.min(axis=1), columns.max(axis=1))

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))


def blocks(batches: Iterator[pa.RecordBatch], dims: int, largest: int) -> Iterator[Block]:
    """Blocks of batches (vec_id, label, q)."""
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, dims))))
    held: list[tuple] = []
    rows = 0

    def block() -> Block:
        return Block.of(*(np.concatenate([h[i] for h in held]) for i in range(3)), largest)

    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, size - rows)
            held.append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("q"), dims)))
            rows += part.num_rows
            start += part.num_rows
            if rows == size:
                yield block()
                held, rows = [], 0
    if rows:
        yield block()


def scan(block: Block, at: np.ndarray, anchor: np.ndarray, order: np.ndarray, least: float, most: float, best: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of ``at``) and exact scores of the rows with ``least`` <= score <= ``most``, and with ``best`` at
    least all those that are among the ``best`` highest (ties included)."""
    anchor = anchor.astype(block.columns.dtype)
    ends = np.sort(np.stack([anchor * block.low, anchor * block.high]), axis=0)[:, order]
    # bounds of what the dimensions from each place of the order on can add
    rest = np.concatenate([np.cumsum(ends[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1), ends.dtype)], axis=1)
    partial = np.zeros(len(at), block.columns.dtype)
    whole = len(at) == len(block.ids)
    for start in range(0, len(order), STRIDE):
        read = order[start : start + STRIDE]
        partial = partial + anchor[read] @ (block.columns[read] if whole else block.columns[np.ix_(read, at)])
        low, high = rest[:, min(start + STRIDE, len(order))]
        if best is not None and len(at) > best:
            least = max(least, np.partition(partial, len(at) - best)[len(at) - best] + low)
        alive = (partial + high >= least) & (partial + low <= most)
        left = int(alive.sum())
        if not left:
            return at[:0], partial[:0]
        if left < 0.8 * len(at):
            at, partial, whole = at[alive], partial[alive], False
    alive = (partial >= least) & (partial <= most)
    return at[alive], partial[alive]


class Best:
    """The first few rows of an anchor by descending score, then ascending id."""

    def __init__(self, count: int):
        self.count, self.scores, self.ids = count, np.empty(0, np.int64), np.empty(0, np.int64)

    def bound(self) -> float:
        """Rows below this score are not among them."""
        return self.scores[-1] if len(self.scores) == self.count else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores.astype(np.int64)]), np.concatenate([self.ids, ids])
            first = np.lexsort((ids, -scores))[: self.count]
            self.scores, self.ids = scores[first], ids[first]


@dataclass(frozen=True)
class Anchors:
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray

    def orders(self) -> np.ndarray:
        return np.argsort(-np.abs(self.rows.astype(np.int64)), axis=1, kind="stable")

    def largest(self) -> int:
        return int(np.abs(self.rows.astype(np.int64)).max(initial=0))


def _positives(anchors: Anchors, dims: int, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scans for the ``count`` best other rows of each anchor's label: (anchor_id, positive_id, positive_score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, orders = [Best(count) for _ in anchors.ids], anchors.orders()
        for block in blocks(batches, dims, anchors.largest()):
            for i, (own, label) in enumerate(zip(anchors.ids, anchors.labels)):
                at = np.arange(*block.of_label(label))
                at = at[block.ids[at] != own]
                if len(at):
                    at, scores = scan(block, at, anchors.rows[i], orders[i], best[i].bound(), np.inf, count)
                    best[i].add(scores, block.ids[at])
        sizes = [len(b.ids) for b in best]
        columns = [np.repeat(anchors.ids, sizes), np.concatenate([b.ids for b in best]), np.concatenate([b.scores for b in best])]
        yield pa.record_batch(list(map(pa.array, columns)), ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(anchors: Anchors, windows: list[list[tuple[int, int, int]]], dims: int, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scans for the ``count`` best rows of other labels in each of an anchor's windows (positive score, least, most):
    (anchor_id, positive_score, negative_id, negative_score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, orders = [[Best(count) for _ in w] for w in windows], anchors.orders()
        for block in blocks(batches, dims, anchors.largest()):
            for i, label in enumerate(anchors.labels):
                if not windows[i]:
                    continue
                least = min(max(low, b.bound()) for (_, low, _), b in zip(windows[i], best[i]))
                most = max(high for _, _, high in windows[i])
                start, stop = block.of_label(label)
                at = np.concatenate([np.arange(start), np.arange(stop, len(block.ids))])
                if len(at):
                    at, scores = scan(block, at, anchors.rows[i], orders[i], least, most, None)
                    for (_, low, high), kept in zip(windows[i], best[i]):
                        inside = (scores >= max(low, kept.bound())) & (scores <= high)
                        kept.add(scores[inside], block.ids[at[inside]])
        found = [(own, w[0], b) for own, ws, bs in zip(anchors.ids, windows, best) for w, b in zip(ws, bs) if len(b.ids)]
        sizes = [len(b.ids) for _, _, b in found]
        columns = [np.repeat(np.array([f[k] for f in found], np.int64), sizes) for k in (0, 1)]
        columns += [np.concatenate([np.empty(0, np.int64), *(getattr(b, k) for _, _, b in found)]) for k in ("ids", "scores")]
        yield pa.record_batch(list(map(pa.array, columns)), ["anchor_id", "positive_score", "negative_id", "negative_score"])

    return run


def _first(rows: DataFrame, keys: list[str], score: str, row: str, count: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), row)
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= count)


def hard_negatives(vectors: DataFrame, anchor: str, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` (a
    SQL condition on vec_id) picks from ``vectors`` (vec_id, label, q as of ``quantised``).

    A row's score is its inner product with the anchor, higher first, ties by smaller vec_id. An anchor's positives are
    its first ``positives`` other rows of the same label; for each of them the first ``negatives`` rows of other labels
    are returned with low * positive_score <= 100 * negative_score <= high * positive_score. Vectors of different
    lengths are compared as if filled up with zeros. Positives without negatives give no row, an empty table none.
    """
    spark = vectors.sparkSession
    sizes = vectors.agg(F.count("*"), F.max(F.size("q")), F.count_if(F.expr(anchor))).first()
    rows, dims, picked = (int(v or 0) for v in sizes)
    folder = fresh_folder(spark, "vectors")
    per_file = max(BLOCK_ROWS // 2, min(1 << 18, rows // (4 * parallelism(spark))))
    vectors.select("vec_id", "label", "q").write.option("maxRecordsPerFile", per_file).parquet(folder)
    vectors = spark.read.schema("vec_id long, label long, q array<int>").parquet(folder)
    passes = max(1, -(-picked * 4 * max(1, dims) // ANCHOR_BYTES))
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    results = spark.createDataFrame([], kind)
    for number in range(passes):
        mine = vectors.where(F.expr(anchor) & (F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number)).toArrow().combine_chunks()
        if not mine.num_rows:
            continue
        batch = mine.to_batches()[0]
        anchors = Anchors(batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("q"), dims))
        close = vectors.mapInArrow(_positives(anchors, dims, positives), "anchor_id long, positive_id long, positive_score long")
        close = stored(_first(close, ["anchor_id"], "positive_score", "positive_id", positives, "place").drop("place"), "positives")
        scores: dict[int, set[int]] = {}
        for r in close.select("anchor_id", "positive_score").distinct().collect():
            scores.setdefault(r["anchor_id"], set()).add(r["positive_score"])
        spans = [[(p, -(-low * p // 100), high * p // 100) for p in sorted(scores.get(int(i), ()), reverse=True)] for i in anchors.ids]
        spans = [[w for w in s if w[1] <= w[2]] for s in spans]
        far = vectors.mapInArrow(_negatives(anchors, spans, dims, negatives), "anchor_id long, positive_score long, negative_id long, negative_score long")
        far = _first(far, ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives, "rank")
        found = close.join(far, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        results = results.unionByName(stored(found, "negatives"))
    return results
