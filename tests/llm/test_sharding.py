import random
from collections import Counter

import pytest

from tests.llm.frames import TEXTS, documents
from tidemark.llm.sharding import hypergeometric, matrix, shuffle_into_shards


def test_exact_shards_and_slots(spark):
    docs = spark.range(1003).selectExpr("id AS doc_id", "id % 7 AS text").repartition(5)
    rows = shuffle_into_shards(docs, 16, block_rows=10).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert sorted(sizes.values()) == [62] * 5 + [63] * 11 and sorted(r["doc_id"] for r in rows) == list(range(1003))
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_same_seed_same_shuffle_other_seed_another(spark, tmp_path):
    spark.range(500).repartition(3).write.parquet(f"{tmp_path}/rows")
    docs = spark.read.parquet(f"{tmp_path}/rows")
    place = lambda seed: sorted(map(tuple, shuffle_into_shards(docs, 4, seed).collect()))
    assert place(1) == place(1) != place(2)


def test_edge_rows_and_clashing_names(spark):
    found = shuffle_into_shards(documents(spark), 4)
    assert found.count() == len(TEXTS) and found.columns.count("shard") == 1
    assert max(Counter(r["shard"] for r in found.collect()).values()) == -(-len(TEXTS) // 4)
    assert shuffle_into_shards(documents(spark, []), 4).count() == 0


@pytest.mark.parametrize("good,bad,draws", [(3, 5, 4), (40, 60, 30), (500, 1500, 700), (10**12, 3 * 10**12, 10**6)])
def test_hypergeometric_moments(good, bad, draws):
    rng, n = random.Random(5), 6000
    values = [hypergeometric(rng, good, bad, draws) for _ in range(n)]
    total = good + bad
    mean = draws * good / total
    variance = mean * bad / total * (total - draws) / (total - 1)
    assert abs(sum(values) / n - mean) < 5 * (variance / n) ** 0.5
    assert abs(sum((v - mean) ** 2 for v in values) / n / variance - 1) < 0.12
    assert max(0, draws - bad) <= min(values) and max(values) <= min(draws, good)


def test_hypergeometric_distribution_by_rejection():
    """The sampler for wide ranges against the exact probabilities."""
    from math import comb

    rng, n = random.Random(9), 40_000
    found = Counter(hypergeometric(rng, 200, 300, 100) for _ in range(n))
    chi = sum((found[k] - e) ** 2 / e for k in range(101) if (e := n * comb(200, k) * comb(300, 100 - k) / comb(500, 100)) > 8)
    assert chi < 80


def test_matrix_sums():
    sizes, targets = [5, 0, 100, 37, 1], [48, 48, 47]
    rows = matrix(sizes, targets, 3)
    assert [sum(r) for r in rows] == sizes and [sum(c) for c in zip(*rows)] == targets
