import hashlib
import random

import numpy as np
import pytest

from tests.llm.frames import LONG, TEXTS, documents, prose
from tidemark.llm import multiset_prints
from tidemark.llm.multiset_prints import edited_likeness, fingerprints, from_hex, likeness, prints_of, to_hex, updated


def brute(texts):
    """(doc_id, n_chars, edited_sha256, text, edited text, next text) by the definition."""
    rows = [(i, t or "") for i, t in texts]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).hexdigest()))
    out = []
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), t, edited, after))
    return out


def hexes(texts):
    return to_hex(prints_of([t.encode() for t in texts]))


def alike(a, b):
    return likeness(prints_of([a.encode()]), prints_of([b.encode()]))[0]


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ranges,partitions", [(2, 4), (64, 3)])
def test_rows_by_brute_force(spark, monkeypatch, ranges, partitions):
    monkeypatch.setattr(multiset_prints, "RANGES", ranges)
    monkeypatch.setattr(multiset_prints, "LOOKS", 1)
    expected = []
    for i, n, sha, text, edited, after in brute(TEXTS):
        own, other = hexes([text, edited])
        expected.append((i, n, sha, own, other, alike(text, edited), alike(text, after)))
    found = held(edited_likeness(documents(spark).repartition(partitions)))
    assert found == sorted(expected, key=repr)


def test_empty_table_and_single_row(spark):
    assert edited_likeness(documents(spark, [])).count() == 0
    assert fingerprints(documents(spark, [])).count() == 0
    (row,) = edited_likeness(documents(spark, [(5, "abcdé")])).collect()
    assert row["edited_sha256"] == hashlib.sha256("abcab".encode()).hexdigest() and row["near_next"] == 1.0


def test_many_rows_of_one_doc_id(spark):
    texts = [(7, "one text\nof two lines")] * 400 + [(i, prose(i, 20)) for i in range(100, 700)]
    found = edited_likeness(documents(spark, texts).repartition(7)).select("doc_id", "n_chars", "edited_sha256")
    assert held(found) == sorted((r[:3] for r in brute(texts)), key=repr)


def test_order_of_paragraphs_does_not_count():
    lines = [prose(i, 12) for i in range(30)] + ["", "", "x"]
    shuffled = random.Random(1).sample(lines, len(lines))
    a, b, c, d = hexes(["\n".join(lines), "\n".join(shuffled), "\n".join(lines[1:]), "\n".join(lines) + "\n"])
    assert a == b and len({a, c, d}) == 3
    # white space and case are not seen by the signed lanes, but by the uniform ones
    assert len(set(hexes(["a b", "a  b", "A b", "a b "]))) == 4


def test_long_texts_are_summed_from_parts(monkeypatch):
    text = LONG.replace(" ", "\n", 20_000)
    whole = hexes([text, "short", LONG])
    monkeypatch.setattr(multiset_prints, "PART_BYTES", 1000)
    assert hexes([text, "short", LONG]) == whole


def test_hex_round_trip():
    prints = prints_of([b"a b c", b"", LONG.encode()])
    again = from_hex(to_hex(prints))
    assert (again[0] == prints[0]).all() and (again[1] == prints[1]).all()


@pytest.mark.parametrize("common", [0, 25, 50, 100, 150, 190, 200])
def test_likeness_follows_the_share_in_common(common):
    errors = []
    for seed in range(20):
        lines = [prose(1000 * seed + i, 10) for i in range(400 - common)]
        a, b = "\n".join(lines[:200]), "\n".join(lines[200 - common :][:200])
        errors.append(alike(a, b) - common / 200)
    assert abs(np.mean(errors)) < 0.06 and np.abs(errors).max() < 0.3
    assert alike(a, a) == 1 and alike("", "") == 1 and alike("", "a") == 0 and alike("a", "a ") == 1


def test_paragraphs_inserted_and_deleted_without_the_text(spark):
    before = {i: [prose(50 * i + j, 9) for j in range(6)] + ["", "same"] for i in range(12)}
    after = {i: list(lines) for i, lines in before.items()}
    edits = []
    for i in range(0, 12, 2):
        edits += [(i, after[i].pop(2), -1), (i, "new words here", 3), (i, None, 1), (i, "came and", 1), (i, "came and", -1)]
        after[i] += ["new words here"] * 3 + [""]
    edits += [(None, "lost", 1), (1, "not counted", None), (99, "a new document", 1)]
    docs = [(i, "\n".join(lines)) for i, lines in before.items()]
    found = updated(fingerprints(documents(spark, docs)), spark.createDataFrame(edits, "doc_id long, paragraph string, n int").repartition(3))
    expected = [(i, "\n".join(lines)) for i, lines in after.items()] + [(99, "a new document")]
    assert held(found) == sorted(zip([i for i, _ in expected], hexes([t for _, t in expected])), key=repr)


def test_hot_document_sends_sums(spark):
    edits = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS doc_id", "concat('line ', id % 11) AS paragraph", "1 AS n")
    none = fingerprints(documents(spark, []))
    rows = {r["doc_id"]: r["fingerprint"] for r in updated(none, edits).collect()}
    lines = [f"line {i % 11}" for i in range(20_000) if i % 3 == 0 or i == 5]
    assert rows[5] == hexes(["\n".join(lines)])[0]
