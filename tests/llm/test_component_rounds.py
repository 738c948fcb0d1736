"""Components of links: no rounds for edges that are stars, later links are merged by roots alone."""

import random

from tidemark.llm import near_copies, simhash


def _roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def test_stars_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(simhash, "stored", lambda df, purpose: written.append(purpose) or df.localCheckpoint())
    edges = spark.createDataFrame([(1, 2), (1, 3), (5, 9)], "a long, b long")
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5} and written == ["links"]


def test_chains_cycles_and_nothing(spark):
    for pairs in ([(i, i + 1) for i in range(40)], [(1, 2), (2, 3), (1, 3), (9, 4), (4, 9)], [(3, 4), (1, 4)], []):
        edges = spark.createDataFrame(pairs, "a long, b long")
        assert {r["node"]: r["root"] for r in simhash.components(edges).collect()} == _roots(pairs)


def test_later_links_are_merged_by_roots(spark, monkeypatch):
    rng = random.Random(4)
    pairs = [(min(p), max(p)) for p in (rng.sample(range(60), 2) for _ in range(30))]
    more = [(min(p), max(p)) for p in (rng.sample(range(80), 2) for _ in range(12))]
    joined = simhash.components(spark.createDataFrame(pairs, "a long, b long")).localCheckpoint()
    searched = []
    monkeypatch.setattr(near_copies, "components", lambda e: searched.append(e.count()) or simhash.components(e))
    found = near_copies._merged(joined, spark.createDataFrame(more, "a long, b long")).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["root"] for r in found} == _roots(pairs + more)
    assert searched and max(searched) <= len(more)
