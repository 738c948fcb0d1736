import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.frames import TEXTS, documents, ids, prose
from tidemark.llm import common, substring_dedup
from tidemark.llm.substring_dedup import without_repeats
from tidemark.llm.suffixes import cover_ranks, equal_runs, prefixes, sorted_bucket

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(texts, length=50):
    first = {}
    for doc_id, text in texts:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            if doc_id is not None:
                first[data[p : p + length]] = min(first.get(data[p : p + length], doc_id), doc_id)
    out = []
    for doc_id, text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            if doc_id is not None and first[data[p : p + length]] < doc_id:
                gone[p : p + length] = True
        gone = gone[:-1]
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages():
    shared = [prose(50 + i, 30) for i in range(4)]
    return [(200 + i, f"{prose(300 + i, i % 5 * 10)} {shared[i % 4][i % 7 :]} {prose(400 + i, 8)}{shared[(i + 1) % 4][: 40 + i]}") for i in range(60)]


def test_brute_force(spark):
    texts = TEXTS + passages()
    assert ids(without_repeats(documents(spark, texts).repartition(4)), *COLUMNS) == brute(texts)


def test_small_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 500)
    monkeypatch.setattr(substring_dedup, "BUCKET_SUFFIXES", 16)
    texts = passages() + [(900, "ab" * 200), (901, "ba" * 150), (902, "a" * 120), (903, "a" * 49), (904, "a" * 50)]
    assert ids(without_repeats(documents(spark, texts)), *COLUMNS) == brute(texts)


def test_empty_table(spark):
    assert without_repeats(documents(spark, [])).count() == 0


def test_kept_bytes(spark):
    texts = [(1, prose(8, 30)), (2, "é" + prose(8, 30) + "ü")]
    assert [bytes(r["kept"]).decode() for r in without_repeats(documents(spark, texts)).where("doc_id = 2").collect()] == ["éü"]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.integers(0, 3))
def test_suffix_order(data, fold):
    text = np.frombuffer(data, np.uint8) >> (fold * 2)  # small alphabets make long ties
    padded = np.concatenate([text, np.zeros(14, np.uint8)])
    heads = prefixes(padded)
    order = sorted_bucket(np.arange(len(text)), heads, cover_ranks(heads))
    whole = padded.tobytes()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: whole[i:])


@pytest.mark.parametrize("limit", [3, 1000])
def test_equal_runs(limit):
    rng = np.random.default_rng(0)
    text = np.concatenate([rng.integers(0, 2, 400).astype(np.uint8), np.zeros(60, np.uint8)])
    groups = []
    for order, new in equal_runs(text, np.arange(400), 20, limit):
        groups += [frozenset(g.tolist()) for g in np.split(order, np.flatnonzero(new)[1:])]
    expected = {}
    for i in range(400):
        expected.setdefault(text[i : i + 20].tobytes(), set()).add(i)
    assert sorted(map(sorted, groups)) == sorted(map(sorted, expected.values()))


def test_hot_anchors_stay_within_blocks(spark, monkeypatch):
    """A passage in a third of all documents, each in its own context: its anchors go by their strings."""
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 4000)
    passage = prose(77, 30)
    texts = [(i, f"{prose(1000 + i, 12)}{passage if i % 3 == 0 else ''}{prose(5000 + i, 12)}") for i in range(600)]
    docs = documents(spark, texts).repartition(4)
    assert ids(without_repeats(docs), *COLUMNS) == brute(texts)


def segment_rows(n_anchors=60, per_anchor=10):
    """Segments of anchors with a shared string here and there, sorted by h."""
    rng = np.random.default_rng(5)
    rows = []
    for h in range(n_anchors):
        common = rng.integers(97, 123, 84).astype(np.uint8)
        for k in range(per_anchor):
            own = rng.integers(65, 91, 84).astype(np.uint8)
            own[k * 3 : 84 - k] = common[k * 3 : 84 - k]
            own[34:50] = common[34:50]
            low = int(rng.integers(0, 50))
            rows.append(dict(h=h, segment=own.tobytes(), low=low, high=low + int(rng.integers(0, 9)), key=h * 100 + k, anchor=34))
    return rows


def test_blocks_in_bounds_give_the_least_holder(monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(substring_dedup, "BUCKET_SUFFIXES", 64)
    rows = segment_rows()
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 37]) for i in range(0, len(rows), 37)]
    blocks = list(substring_dedup._blocks(iter(batches)))
    assert sum(b.num_rows for b in blocks) == len(rows) and len(blocks) > 5
    assert max(b.num_rows for b in blocks) * 84 <= 4000 + 2 * 10 * 84
    assert all(a.column("h")[-1] != b.column("h")[0] for a, b in zip(blocks, blocks[1:]))
    first = {}
    for r in rows:
        for p in range(35):
            string = (r["h"], r["segment"][p : p + 50])
            first[string] = min(first.get(string, r["low"]), r["low"])
    expected = {r["key"]: [first[r["h"], r["segment"][p : p + 50]] for p in range(35)] for r in rows}
    expected = {r["key"]: expected[r["key"]] for r in rows if min(expected[r["key"]]) < r["high"]}
    found = {}
    for batch in substring_dedup._least_holders(iter(batches)):
        for r in batch.to_pylist():
            found[r["key"]] = [least for a, b, least in zip(r["at"], r["until"], r["least"]) for _ in range(a, b)]
    assert found == expected


def test_segments_that_cannot_meet_are_not_sorted():
    """The side filter keeps every segment that shares a string with another of its anchor."""
    rng = np.random.default_rng(3)
    shared = rng.integers(97, 101, 84).astype(np.uint8).tobytes()
    anchor = 34
    for cut in range(35):
        left, right = shared[:anchor], shared[anchor + 16 :]
        # the other segment agrees on the string that begins ``cut`` bytes into the first, and nowhere else
        other = bytes(256 - b for b in left[:cut]) + shared[cut : cut + 50] + bytes(256 - b for b in shared[cut + 50 :])
        assert left and right
        data = np.frombuffer(shared + other, np.uint8)
        h = np.zeros(2, np.int64)
        may = substring_dedup._meeting(h, data, np.array([0, 84]), np.array([84, 84]), np.array([anchor, anchor]))
        assert may.all(), cut


@pytest.mark.parametrize("bits", [1 << 13, 1 << 27])
def test_segments_that_leave_do_not_depend_on_the_size_of_a_filter(spark, monkeypatch, tmp_path, bits):
    """More shared anchors than one filter holds let no other segments through, and no table of segments stays."""
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 20_000)
    kept, folder, store = {}, str(tmp_path / "cut"), substring_dedup.stored

    def counting(df, purpose, *rest, **named):
        out = store(df, purpose, *rest, **named)
        kept[purpose] = out.count()
        return out

    monkeypatch.setattr(substring_dedup, "stored", counting)
    monkeypatch.setattr(substring_dedup, "fresh_folder", lambda _, purpose: f"{folder}-{purpose}", raising=False)
    shared = [prose(700 + i, 400) for i in range(6)]
    texts = [(i, prose(2000 + i, 120)) for i in range(150)] + [(1000 + i, f"{prose(3000 + i, 5)} {shared[i % 6]}") for i in range(18)]
    # sixteen bytes that all documents hold, between bytes of their own
    texts = [(i, f"{text} {prose(6000 + i, 9)}{'=' * 16}{prose(9000 + i, 9)}") for i, text in texts]
    assert ids(without_repeats(documents(spark, texts).repartition(4)), *COLUMNS) == brute(texts)
    everything = sum(len(substring_dedup.segments(*common.raw_bytes(pa.array([t])))[0]) for _, t in texts)
    within = sum(len(substring_dedup.segments(*common.raw_bytes(pa.array([shared[i % 6]])))[0]) for i in range(18))
    assert within < kept["segments"] + 18 * 4 and kept["segments"] < within + 0.1 * (everything - within)
    assert not list(tmp_path.iterdir())


def test_strings_are_not_broadcast(spark):
    rows = [(h, bytes([65 + h]) * 40 + prose(h, 9).encode()[:40], h, 1, 9) for h in range(20)]
    distinct = substring_dedup.stored(spark.createDataFrame(rows, "h long, segment binary, key long, low long, high long"), "crowds")
    plan = substring_dedup._least_holders_by_string(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
