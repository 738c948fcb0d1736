import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.frames import TEXTS, documents, ids
from tidemark.llm.exact_dedup import exact_groups, without_copies
from tidemark.llm.golomb import by_owner, decode, encode


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000, 200_000])
@pytest.mark.parametrize("top", [40, 1 << 20, (1 << 64) - 1])
def test_golomb_round_trip(n, top):
    values = np.unique(np.random.default_rng(n).integers(0, top, n, dtype=np.uint64, endpoint=True))
    assert (decode(encode(values)) == values).all()
    parts = [own for _, own in by_owner(values, 7)]
    assert np.array_equal(np.concatenate(parts) if parts else values, values)


def brute(texts):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in texts]
    groups = defaultdict(list)
    for (i, _), t in zip(texts, norm):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(texts, norm):
        known = [x for x in groups[t] if x is not None]
        keep = min(known) if known else None
        out.append((i, keep if len(groups[t]) > 1 else i, len(groups[t]), i == keep or len(groups[t]) == 1, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups(spark):
    found = exact_groups(documents(spark).repartition(5))
    assert ids(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(TEXTS)


def test_large_group_of_copies(spark):
    texts = [(i, "copied text" if i % 3 else f"own {i}") for i in range(900)]
    found = exact_groups(documents(spark, texts).repartition(9))
    assert ids(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(texts)


def test_empty_table(spark):
    assert exact_groups(documents(spark, [])).count() == 0
    assert without_copies(documents(spark, [])).count() == 0


def test_filter_keeps_columns_and_one_of_repeated_rows(spark):
    docs = documents(spark)
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    by_id = [r["doc_id"] for r in kept.collect()]
    expected = {i for i, k, _, stays, _ in brute(TEXTS) if stays and i is not None}
    assert {i for i in by_id if i is not None} == expected and by_id.count(6) == 1 and by_id.count(None) == 2
