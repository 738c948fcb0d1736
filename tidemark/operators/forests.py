"""Random forests grown by Spark jobs: nodes of many rows by summed histograms, what is below them in tasks.

Features become bins by up to ``BINS`` - 1 thresholds (quantiles of all rows; midpoints where there are few values), and
every row gets a Poisson weight for each tree. While a node has more than ``LOCAL_ROWS`` (weighted) rows, tasks count
classes by bin for its random features, Spark adds the counts up by node and a task picks the split. Then the rows of
each node left are shuffled to it and its subtree is grown there, a level at a time. Nodes stay a stored table: the
driver knows only the few above the subtrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.workspace import fresh_folder, literal_frame

BINS = 32
#: Weighted rows of a node at most that one task grows into a subtree.
LOCAL_ROWS = 8192
#: Bytes of histograms at most that a task holds in a pass, rows of a chunk that is sent to a node at most.
HISTOGRAM_BYTES, CHUNK = 1 << 25, 4096
MAX_CLASSES = 100
#: Shares are multiples of this, so that sums over trees do not depend on their order.
GRID = 2.0**40
NODES = "tree int, sub int, node int, feature int, split int, left int, right int, share array<double>"


@dataclass(frozen=True)
class Top:
    """The nodes above the subtrees and their roots, of all trees; node i < number of trees is the root of tree i."""

    tree: np.ndarray
    feature: np.ndarray  # -1: the root of a subtree
    split: np.ndarray  # the last bin that goes left
    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray

    def walk(self, bins: np.ndarray, tree: int) -> np.ndarray:
        return walk(bins, np.full(len(bins), tree), self.feature, self.split, self.left, self.right)


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame  # NODES: the subtrees, numbered from 0 in each
    top: Top
    thresholds: list[np.ndarray]
    trees: int
    classes: int


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    folder = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _by_subtree(df: DataFrame) -> DataFrame:
    """Dealt to all cores by number: the bytes are few for the work that follows, so the adaptive planner would merge them."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), "tree", "sub")


def walk(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, split: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The leaf that each row reaches from the node ``at``."""
    walking = np.flatnonzero(feature[at] >= 0)
    while len(walking):
        node = at[walking]
        at[walking] = np.where(bins[walking, feature[node]] <= split[node], left[node], right[node])
        walking = walking[feature[at[walking]] >= 0]
    return at


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0)
    values = column.flatten()
    if column.null_count or values.null_count or (sizes != width).any():
        raise ValueError(f"rows need {width} features each, none of them NULL")
    return values.to_numpy().reshape(len(column), width)


def _binned(x: np.ndarray, thresholds: list[np.ndarray]) -> np.ndarray:
    """How many thresholds lie below a value: at most i where the value is not above threshold i. NaN is above all."""
    return np.stack([np.searchsorted(t, x[:, i]) for i, t in enumerate(thresholds)], axis=1).astype(np.uint8)


def _thresholds(vectors: DataFrame, width: int) -> list[np.ndarray]:
    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.empty(0)] * width
        for batch in batches:
            x = _matrix(batch.column(0), width)
            seen = [s if len(s) > BINS else np.unique(np.concatenate([s, x[:, i]]))[: BINS + 1] for i, s in enumerate(seen)]
        place = np.repeat(np.arange(width, dtype=np.int32), [len(s) for s in seen])
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.concatenate(seen))], ["f", "v"])

    values = vectors.select("_x").mapInArrow(few, "f int, v double").distinct().groupBy("f").agg(F.slice(F.sort_array(F.collect_set("v")), 1, BINS + 1).alias("v"))
    points = [i / BINS for i in range(1, BINS)]
    cuts = vectors.select(F.posexplode("_x").alias("f", "v")).groupBy("f").agg(F.percentile_approx("v", points, 10_000).alias("q"), F.max("v").alias("most"))
    out = [np.empty(0)] * width
    for row in values.join(cuts, "f").collect():
        own, q = np.array(row["v"]), np.unique(row["q"])
        out[row["f"]] = (own[1:] + own[:-1]) / 2 if len(own) <= BINS else q[q < row["most"]]
    return out


def _best(hist: np.ndarray, min_leaf: int) -> tuple[int, int]:
    """(feature, last bin that goes left) of the best split by Gini impurity of class counts (features, bins, classes); -1: none."""
    left = hist.cumsum(axis=1)[:, :-1].astype(float)
    whole = hist[0].sum(axis=0).astype(float)
    right = whole - left
    a, b = left.sum(axis=2), right.sum(axis=2)
    gain = (left**2).sum(axis=2) / np.maximum(a, 1) + (right**2).sum(axis=2) / np.maximum(b, 1) - (whole**2).sum() / whole.sum()
    gain[(a < max(1, min_leaf)) | (b < max(1, min_leaf))] = 0
    at = int(gain.argmax())
    return divmod(at, gain.shape[1]) if gain.flat[at] > 1e-12 * whole.sum() else (-1, 0)


def _grown(bins: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, some: int, depth: int, min_leaf: int, rng: np.random.Generator) -> list[np.ndarray]:
    """feature, split, left, right and class counts of the nodes of a subtree, level by level."""
    rows, at, m, first, levels = np.arange(len(y)), np.zeros(len(y), np.int64), 1, 0, []
    while True:
        counts = np.bincount(at * classes + y[rows], w[rows], m * classes).reshape(m, classes)
        total, best = counts.sum(axis=1), np.zeros(m)
        feature, split = np.full(m, -1), np.zeros(m, np.int64)
        best[:] = 1e-12 * total
        undone = ((counts > 0).sum(axis=1) > 1) & (total >= 2 * min_leaf) & (len(levels) < depth)
        chosen = np.argpartition(rng.random((m, bins.shape[1])), some - 1, axis=1)[:, :some]
        mine = undone[at]
        r, a = rows[mine], at[mine]
        for j in range(some if len(r) else 0):
            order = np.argsort(a * BINS + bins[r, chosen[a, j]], kind="stable")
            row, node = r[order], a[order]
            value = bins[row, chosen[node, j]]
            sums = np.zeros((len(row) + 1, classes))
            sums[np.arange(1, len(row) + 1), y[row]] = w[row]
            sums = sums.cumsum(axis=0)
            cut = np.flatnonzero((node[1:] == node[:-1]) & (value[1:] != value[:-1]))
            owner = node[cut]
            left = sums[cut + 1] - sums[np.searchsorted(node, owner)]
            right = counts[owner] - left
            x, z = left.sum(axis=1), right.sum(axis=1)
            gain = (left**2).sum(axis=1) / x + (right**2).sum(axis=1) / z - (counts[owner] ** 2).sum(axis=1) / total[owner]
            gain[(x < min_leaf) | (z < min_leaf)] = 0
            most = np.zeros(m)
            np.maximum.at(most, owner, gain)
            hit = np.flatnonzero((gain == most[owner]) & (gain > best[owner]))[::-1]
            split[owner[hit]], feature[owner[hit]] = value[cut[hit]], chosen[owner[hit], j]
            best = np.maximum(best, most)
        parents = np.flatnonzero(feature >= 0)
        left, right = np.full(m, -1), np.full(m, -1)
        left[parents] = first + m + 2 * np.arange(len(parents))
        right[parents] = left[parents] + 1
        levels.append([feature, split, left, right, counts])
        if not len(parents):
            return [np.concatenate(parts) for parts in zip(*levels)]
        rows, at = rows[feature[at] >= 0], at[feature[at] >= 0]
        below = np.where(bins[rows, feature[at]] <= split[at], left[at], right[at])
        first, m, at = first + m, 2 * len(parents), below - first - m


def _shares(counts: np.ndarray) -> np.ndarray:
    return np.floor(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1) * GRID + 0.5) / GRID


def _unpacked(batch: pa.RecordBatch, width: int, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = batch.num_rows
    bins, w = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, size) for c, size in (("bins", width), ("w", trees)))
    return bins, batch.column("y").to_numpy(), w


def _chunks(top: Top, tree: int, bins: np.ndarray, *others: np.ndarray) -> Iterator[tuple]:
    """(node, bins, others) as bytes: the rows of each subtree."""
    at = top.walk(bins, tree)
    order = np.argsort(at, kind="stable")
    edges = np.flatnonzero(np.diff(at[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)]):
        for c in range(a, b, CHUNK):
            part = order[c : min(b, c + CHUNK)]
            yield int(at[part[0]]), bins[part].tobytes(), *(o[part].tobytes() for o in others)


def _sent(top: Top, tree: int, names: list[str], bins: np.ndarray, *others: np.ndarray) -> pa.RecordBatch:
    found = list(zip(*_chunks(top, tree, bins, *others)))
    columns = [pa.array(np.full(len(found[0]), tree, np.int32)), pa.array(found[0], pa.int32()), *(pa.array(c, pa.binary()) for c in found[1:])]
    return pa.RecordBatch.from_arrays(columns, ["tree", "sub", "bins", *names])


def grow(rows: DataFrame, vector: Column, label: str, trees: int, depth: int, min_leaf: int, seed: int) -> Forest:
    """``vector``: an array of doubles; labels are 0, 1, ... Missing labels or features are an error."""
    vectors = rows.select(vector.alias("_x"), F.col(label).cast("double").alias("_y"))
    odd = F.col("_x").isNull() | F.exists("_x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    y = F.col("_y")
    facts = vectors.agg(
        F.count("*").alias("n"),
        F.count_if(odd | F.size("_x").isNull()).alias("odd"),
        F.count_if(y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y))).alias("no_class"),
        F.max(y).alias("most"),
        F.min(F.size("_x")).alias("width"),
        F.max(F.size("_x")).alias("widest"),
    ).first()
    if not facts["n"] or facts["odd"] or facts["no_class"] or facts["width"] != facts["widest"] or not facts["width"]:
        raise ValueError(f"a forest needs rows with equally many finite features and labels 0, 1, ...: {facts.asDict()}")
    width, classes = facts["width"], int(facts["most"]) + 1
    if classes > MAX_CLASSES:
        raise ValueError(f"'{label}' has classes up to {classes - 1}, more than {MAX_CLASSES}")
    some = width if trees == 1 else ceil(sqrt(width))
    thresholds = _thresholds(vectors, width)

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            bins = _binned(_matrix(batch.column(0), width), thresholds)
            w = np.minimum(rng.poisson(1.0, (len(bins), trees)), 255).astype(np.uint8)
            columns = [pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(batch.column(1).to_numpy().astype(np.int32)), pa.array([b.tobytes() for b in w], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bins", "y", "w"])

    points = _kept(vectors.mapInArrow(point, "bins binary, y int, w binary"), "points")
    top, level = _top(points, facts["n"], width, classes, trees, depth, min_leaf, some, seed)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, y, w = _unpacked(batch, width, trees)
            for tree in range(trees):
                used = np.flatnonzero(w[:, tree])
                if len(used):
                    yield _sent(top, tree, ["y", "w"], bins[used], y[used], w[used, tree])

    def subtree(key: tuple, chunks: pa.Table) -> pa.Table:
        tree, sub = (k.as_py() for k in key)
        bins, y, w = (np.frombuffer(b"".join(chunks.column(c).to_pylist()), kind) for c, kind in (("bins", np.uint8), ("y", np.int32), ("w", np.uint8)))
        rng = np.random.default_rng([seed, trees, sub])
        feature, split, left, right, counts = _grown(bins.reshape(-1, width), y.astype(np.int64), w.astype(float), classes, some, depth - level[sub], max(1, min_leaf), rng)
        share = pa.ListArray.from_arrays(np.arange(0, counts.size + 1, classes, dtype=np.int32), _shares(counts).ravel())
        n = len(feature)
        numbers = [np.full(n, tree), np.full(n, sub), np.arange(n), feature, split, left, right]
        return pa.table([*(pa.array(v.astype(np.int32)) for v in numbers), share], names=["tree", "sub", "node", "feature", "split", "left", "right", "share"])

    sent = _by_subtree(points.mapInArrow(send, "tree int, sub int, bins binary, y binary, w binary"))
    nodes = _kept(sent.groupBy("tree", "sub").applyInArrow(subtree, NODES), "forest")
    return Forest(nodes, top, thresholds, trees, classes)


def _top(points: DataFrame, total: int, width: int, classes: int, trees: int, depth: int, min_leaf: int, some: int, seed: int) -> tuple[Top, np.ndarray]:
    """The nodes above the subtrees and how deep they are. A pass takes as many nodes as ``HISTOGRAM_BYTES`` allow."""
    top = Top(np.arange(trees), np.full(trees, -1), np.zeros(trees, np.int64), np.full(trees, -1), np.full(trees, -1), np.zeros((trees, classes)))
    level, size = np.zeros(trees, np.int64), some * BINS * classes
    most = max(1, HISTOGRAM_BYTES // (4 * size))
    waiting = list(range(trees)) if total > LOCAL_ROWS and depth > 0 else []
    while waiting:
        taken, waiting = np.array(waiting[:most]), waiting[most:]
        taken = taken[np.argsort(top.tree[taken], kind="stable")]
        chosen = np.stack([np.random.default_rng([seed, int(g)]).permutation(width)[:some] for g in taken])
        slots = np.full(len(top.tree), -1)
        slots[taken] = np.arange(len(taken))
        now = top

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hist = np.zeros((len(taken), size), np.int32)
            for batch in batches:
                bins, y, w = _unpacked(batch, width, trees)
                for tree in np.unique(now.tree[taken]):
                    used = np.flatnonzero(w[:, tree])
                    slot = slots[now.walk(bins[used], tree)]
                    used, slot = used[slot >= 0], slot[slot >= 0]
                    if not len(used):
                        continue
                    low = int(slot.min())
                    cell = ((slot - low)[:, None] * some + np.arange(some)) * BINS + bins[used[:, None], chosen[slot]]
                    sums = np.bincount((cell * classes + y[used][:, None]).ravel(), np.repeat(w[used, tree], some))
                    hist.reshape(-1)[low * size : low * size + len(sums)] += sums.astype(np.int32)
            for slot in np.flatnonzero(hist.any(axis=1)):
                yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([hist[slot].tobytes()], pa.binary())], ["slot", "hist"])

        def pick(key: tuple, parts: pa.Table) -> pa.Table:
            slot = key[0].as_py()
            hist = np.zeros((some, BINS, classes), np.int64)
            for part in parts.column("hist").to_pylist():
                hist += np.frombuffer(part, np.int32).reshape(hist.shape)
            feature, split = _best(hist, min_leaf)
            whole = hist[0].sum(axis=0)
            left = hist[feature, : split + 1].sum(axis=0) if feature >= 0 else whole
            found = int(chosen[slot, feature]) if feature >= 0 else -1
            return pa.table([pa.array([slot], pa.int32()), pa.array([found], pa.int32()), pa.array([split], pa.int32()), pa.array([whole.tolist()]), pa.array([left.tolist()])], names=["slot", "feature", "split", "whole", "below"])

        picked = points.mapInArrow(count, "slot int, hist binary").groupBy("slot").applyInArrow(pick, "slot int, feature int, split int, whole array<long>, below array<long>")
        fields = {name: list(getattr(top, name)) for name in ("tree", "feature", "split", "left", "right", "counts")}
        deep = list(level)
        for row in sorted(picked.collect()):
            g = int(taken[row["slot"]])
            whole, below = np.array(row["whole"], float), np.array(row["below"], float)
            fields["counts"][g] = whole
            if row["feature"] < 0:
                continue
            fields["feature"][g], fields["split"][g], fields["left"][g], fields["right"][g] = row["feature"], row["split"], len(deep), len(deep) + 1
            for part in (below, whole - below):
                if part.sum() > LOCAL_ROWS and (part > 0).sum() > 1 and deep[g] + 1 < depth:
                    waiting.append(len(deep))
                for name, value in (("tree", fields["tree"][g]), ("feature", -1), ("split", 0), ("left", -1), ("right", -1), ("counts", part)):
                    fields[name].append(value)
                deep.append(deep[g] + 1)
        top, level = Top(**{name: np.array(values) for name, values in fields.items()}), np.array(deep)
    return top, level


def votes(forest: Forest, rows: DataFrame, vector: Column, key: str) -> DataFrame:
    """(key, p): the mean class shares of the leaves a row reaches. Rows go to the subtrees, these are never sent whole."""
    width = len(forest.thresholds)
    top, thresholds, trees, classes = forest.top, forest.thresholds, forest.trees, forest.classes

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _binned(_matrix(batch.column("_x"), width), thresholds)
            for tree in range(trees):
                yield _sent(top, tree, ["ids"], bins, batch.column("_id").to_numpy())

    def arrive(chunks: pa.Table, nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("node")
        columns = [nodes.column(c).to_numpy() for c in ("feature", "split", "left", "right")]
        share = nodes.column("share").combine_chunks().flatten().to_numpy().reshape(-1, classes)
        bins, ids = (np.frombuffer(b"".join(chunks.column(c).to_pylist()), kind) for c, kind in (("bins", np.uint8), ("ids", np.int64)))
        found = share[walk(bins.reshape(-1, width), np.zeros(len(ids), np.int64), *columns)] if len(ids) else np.empty((0, classes))
        return pa.table([pa.array(ids), *(pa.array(np.ascontiguousarray(c)) for c in found.T)], names=["_id", *(f"p{i}" for i in range(classes))])

    sent = rows.select(F.col(key).alias("_id"), vector.alias("_x")).mapInArrow(send, "tree int, sub int, bins binary, ids binary")
    shape = ", ".join(["_id long", *(f"p{i} double" for i in range(classes))])
    each = _by_subtree(sent).groupBy("tree", "sub").cogroup(_by_subtree(forest.nodes).groupBy("tree", "sub")).applyInArrow(arrive, shape)
    summed = each.groupBy("_id").agg(*(F.sum(f"p{i}").alias(f"p{i}") for i in range(classes)))
    shares = F.array(*(F.col(f"p{i}") for i in range(classes)))
    whole = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return summed.select(F.col("_id").alias(key), F.transform(shares, lambda v: v / whole).alias("p"))


def numbered(forest: Forest, spark: SparkSession) -> DataFrame:
    """(tree, node, feature, threshold, left, right, share): all nodes, numbered from 0 in each tree."""
    top = forest.top
    order = np.argsort(top.tree, kind="stable")
    first = np.searchsorted(top.tree[order], np.arange(forest.trees))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order)) - first[top.tree[order]]
    number = np.bincount(top.tree, minlength=forest.trees)[top.tree]
    roots = literal_frame(spark, {"sub": list(range(len(place))), "place": place.tolist(), "tops": number.tolist()})
    sizes = forest.nodes.groupBy("tree", "sub").agg((F.count("*") - 1).alias("more")).join(F.broadcast(roots), "sub")
    before = F.sum("more").over(Window.partitionBy("tree").orderBy("sub")) - F.col("more")
    starts = sizes.select("tree", "sub", "place", (F.col("tops") + before - 1).alias("start"))
    own = forest.nodes.join(F.broadcast(starts), ["tree", "sub"])
    moved = lambda c: F.when(F.col(c) > 0, F.col("start") + F.col(c)).when(F.col(c) == 0, F.col("place")).otherwise(-1).cast("int").alias(c)
    cuts = F.array(*(F.array(*(F.lit(float(v)) for v in t)).cast("array<double>") for t in forest.thresholds))
    threshold = F.when(F.col("feature") >= 0, F.get(F.get(cuts, F.col("feature")), F.col("split"))).alias("threshold")
    below = own.select("tree", moved("node"), "feature", threshold, moved("left"), moved("right"), "share")
    inner = np.flatnonzero(top.feature >= 0)
    if not len(inner):
        return below
    above = {
        "tree": top.tree[inner].tolist(),
        "node": place[inner].tolist(),
        "feature": top.feature[inner].tolist(),
        "threshold": [float(forest.thresholds[f][s]) for f, s in zip(top.feature[inner], top.split[inner])],
        "left": place[top.left[inner]].tolist(),
        "right": place[top.right[inner]].tolist(),
        "share": _shares(top.counts[inner]).tolist(),
    }
    ints = {c: F.col(c).cast("int") for c in ("tree", "node", "feature", "left", "right")}
    return below.unionByName(literal_frame(spark, above).withColumns(ints))
