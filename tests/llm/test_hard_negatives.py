import math

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import hard_negatives as module
from tidemark.llm.hard_negatives import LARGEST, Block, Best, hard_negatives, quantised, scan

ANCHOR = "vec_id % 10 = 0"
SCHEMA = "vec_id long, label int, embedding array<float>, score double, q string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, y, v, None, None, None) for i, y, v in rows], SCHEMA)


def brute(rows, positives=5, negatives=5, low=80, high=100, every=10):
    kept = {}
    for i, y, v in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [max(-LARGEST, min(LARGEST, math.floor(256 * float(np.float32(x))))) for x in v]
        kept[i] = min(kept.get(i, (y, q)), (y, q))
    out = []
    for a, (label, q) in kept.items():
        if a % every:
            continue
        ranked = sorted((-sum(x * z for x, z in zip(q, p)), i, y) for i, (y, p) in kept.items())
        near = [(-s, i) for s, i, y in ranked if y == label and i != a][:positives]
        for score, i in near:
            far = [(-s, j) for s, j, y in ranked if y != label and low * score <= 100 * -s <= high * score][:negatives]
            out += [(a, i, k + 1, j, score, s) for k, (s, j) in enumerate(far)]
    return sorted(out)


def vectors(seed, n, dims=16, labels=4, digits=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        y = int(rng.integers(labels))
        v = centres[y if rng.random() < 0.7 else int(rng.integers(labels))] + rng.normal(size=dims) * 0.4
        rows.append((i, y, [round(float(x), digits) for x in v]))
    return rows


def held(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block,anchor_bytes", [(8192, 1 << 24), (16, 1 << 24), (37, 256)])
def test_by_brute_force(spark, monkeypatch, block, anchor_bytes):
    monkeypatch.setattr(module, "BLOCK_ROWS", block)
    monkeypatch.setattr(module, "ANCHOR_BYTES", anchor_bytes)
    rows = vectors(1, 300)
    found = hard_negatives(quantised(frame(spark, rows).repartition(6)), ANCHOR)
    assert held(found) == brute(rows) and found.count() > 200


def test_ties_copies_and_a_hot_label(spark):
    """Coarse values tie; a third of the rows are copies of one vector, and most rows share one label."""
    rows = [(i, y if i % 5 else 0, [float(round(x)) for x in v]) for i, y, v in vectors(2, 240, dims=4)]
    rows += [(1000 + i, i % 2, [1.0, 0.0, -1.0, 1.0]) for i in range(120)]
    assert held(hard_negatives(quantised(frame(spark, rows)), ANCHOR)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, 60) + [
        (None, 1, [1.0] * 16), (200, None, [1.0] * 16), (201, 1, None), (202, 1, [nan] * 16), (203, 1, [1.0, None]), (210, 1, [inf] + [0.0] * 15),
        (220, 1, []), (221, 1, [1.0]), (230, 2, [0.5] * 20), (231, 2, [0.4] * 20), (232, 3, [0.39] * 20), (-10, 0, [-0.5] * 16), (-7, 2, [-0.5] * 16),
        (240, 3, [3e38, -3e38, 1.0]), (241, 3, [2e38, -1.0, 2.0]), (242, 1, [2e38, -1.0, 1.0]),
        (5, 0, [9.0] * 16), (10, 3, [1.0] * 16), (10, 2, [1.0] * 16), (10, 2, [1.0] * 16),
    ]
    assert held(hard_negatives(quantised(frame(spark, rows).repartition(3)), ANCHOR)) == brute(rows)


def test_empty_tables_and_no_anchors(spark):
    assert hard_negatives(quantised(frame(spark, [])), ANCHOR).count() == 0
    assert hard_negatives(quantised(frame(spark, vectors(4, 20))), "false").count() == 0
    assert held(hard_negatives(quantised(frame(spark, vectors(4, 1))), ANCHOR)) == []


def test_other_bounds(spark):
    rows = vectors(5, 150)
    found = hard_negatives(quantised(frame(spark, rows)), ANCHOR, positives=3, negatives=7, low=-50, high=120)
    assert held(found) == brute(rows, 3, 7, -50, 120)


@pytest.mark.parametrize("largest", [300, 1 << 50])
def test_scan_drops_only_what_is_out_of_bounds(largest):
    rng = np.random.default_rng(6)
    rows = rng.integers(-200, 200, (500, 24)).astype(np.int32)
    block = Block.of(np.arange(500), np.zeros(500, np.int64), rows, largest)
    assert block.columns.dtype == (np.float64 if largest == 300 else np.int64)
    anchor = rng.integers(-200, 200, 24)
    exact = rows.astype(np.int64) @ anchor
    order = np.argsort(-np.abs(anchor))
    at, scores = scan(block, np.arange(500), anchor, order, 20_000, 60_000, None)
    assert sorted(at) == sorted(np.flatnonzero((exact >= 20_000) & (exact <= 60_000))) and (scores == exact[at]).all()
    at, scores = scan(block, np.arange(500), anchor, order, -np.inf, np.inf, 5)
    assert set(np.argsort(-exact)[:5]) <= set(at) and (scores == exact[at]).all() and len(at) < 50


def test_best_keeps_ties_by_id():
    best = Best(3)
    best.add(np.array([5.0, 7.0]), np.array([9, 8]))
    assert best.bound() == -np.inf
    best.add(np.array([5.0, 5.0, 1.0]), np.array([4, 6, 1]))
    assert best.ids.tolist() == [8, 4, 6] and best.bound() == 5


def test_lists_of_other_lengths_are_filled_up():
    got = module._matrix(pa.array([[9], [1, 2, 3], [], [4]], pa.list_(pa.int32())).slice(1), 3)
    assert got.tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0]]
