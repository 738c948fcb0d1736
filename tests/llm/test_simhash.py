import random
import re

import pytest
import xxhash

from tests.llm.frames import TEXTS, documents, ids, prose
from tidemark.llm import simhash
from tidemark.llm.simhash import components, links, near_groups, without_near_copies

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(prints):
    """Component by repeated search, over distinct fingerprints."""
    left, found = set(prints), {}
    while left:
        stack = [left.pop()]
        group = set(stack)
        while stack:
            x = stack.pop()
            near = {y for y in left if (x ^ y).bit_count() <= 2}
            left -= near
            group |= near
            stack += near
        found |= {x: frozenset(group) for x in group}
    return found


def brute(texts):
    prints = [fingerprint(t) for _, t in texts]
    group = closure(prints)
    smallest = {}
    for (i, _), p in zip(texts, prints):
        g = group[p]
        smallest[g] = min((x for x in (smallest.get(g), i) if x is not None), default=None)
    return sorted(((i, format(p, "016x"), smallest[group[p]]) for (i, _), p in zip(texts, prints)), key=repr)


def near_texts():
    base = prose(4, 900).split()
    out = []
    for i in range(60):
        copy = list(base)
        for k in range(i % 4):
            copy[(97 * i + 211 * k) % len(copy)] = f"edit{i % 9}"
        out.append((i + 100, " ".join(copy)))
    return out


def test_brute_force(spark):
    texts = TEXTS + near_texts()
    assert ids(near_groups(documents(spark, texts)), "doc_id", "fingerprint", "component_id") == brute(texts)


def test_empty_table(spark):
    assert near_groups(documents(spark, [])).count() == 0


@pytest.mark.parametrize("crowd", [0, 3, 512])
def test_links_whatever_is_crowded(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng, values = random.Random(2), set()
    for _ in range(12):
        x = rng.getrandbits(64)
        values |= {x} | {x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for _ in range(8)}
        values |= {x ^ (rng.getrandbits(32) << 32), x ^ rng.getrandbits(32)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = {(r["a"], r["b"]) for r in links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    assert found == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}


@pytest.mark.parametrize("crowd", [0, 512])
def test_balls_are_not_broadcast(spark, monkeypatch, crowd):
    """Spark takes 33 or 2,081 rows after an explode for the one before it: broadcast, they fill the driver."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(3)
    values = {rng.getrandbits(20) for _ in range(300)} | {rng.getrandbits(63) for _ in range(300)}
    found = links(spark.createDataFrame([(v,) for v in values], "fp long"))
    lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
    balls = [i for i, line in enumerate(lines) if "Generate explode" in line]
    assert len(balls) == 2
    for i in balls:
        depth, above = lines[i].index("Generate"), []
        for line in reversed(lines[:i]):
            at = re.search(r"[A-Z]", line).start()
            if at < depth:
                depth = at
                above.append(line[at:])
        assert any(line.startswith("SortMergeJoin") for line in above) and not any(line.startswith("Broadcast") for line in above)


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(501, 540)] + [(520, 700), (1, 2), (2, 1)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    expected = {x: 100 for x in range(100, 161)} | {x: 500 for x in [*range(500, 540), 700]} | {1: 1, 2: 1}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter(spark):
    texts = TEXTS + near_texts()
    docs = documents(spark, texts)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r[0] for r in kept.select("doc_id").collect()), key=repr) == sorted((i for i, _, c in brute(texts) if i is None or i == c), key=repr)
