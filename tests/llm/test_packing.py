import os
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.frames import TEXTS, documents
from tidemark.llm import tokens
from tidemark.llm.packing import QUANTUM, pack, solve
from tidemark.llm.tokens import encode

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["", " ", "  two", "a  b", "a\n b", "tab\t x", " lead", "trail ", "a  b", "x　y z", "it's 12,000 <|endoftext|> ok", "<| endoftext |>", "a\r\n b", "né 中文 words", "emoji 👍🏽 x", "a \x0b b", "a\x85 b", "\n\n x", "word " * 500, None]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    for texts in (ODD, ["plain words only"], [], [None], ["ȏ ȐƩ words ɐ ᵃ 𝒳 x"]):
        ids, bounds = encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_in_steps(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "STEP", 7)
    texts = [*ODD, "one two three four five six seven eight nine ten one two", "", "a b c d e f g", "it's <|endoftext|>"]
    ids, bounds = encode(pa.array(texts, pa.string()))
    assert ids.dtype == np.int32 and len(ids) == bounds[-1]
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_tokenizer_is_loaded_where_a_text_needs_it():
    tokens._whole.cache_clear()
    encode(pa.array(["plain words only", None, ""]))
    assert tokens._whole.cache_info().currsize == 0
    encode(pa.array(["two  spaces  b"]))
    assert tokens._whole.cache_info().currsize == 1


def test_encoding_holds_a_few_times_the_text():
    words = np.random.default_rng(4).integers(97, 123, (1 << 17, 7)).astype(np.uint8)
    words[:, -1] = 32
    text = words.tobytes().decode().strip()
    encode(pa.array(["warm up"]))
    tracemalloc.start()
    encode(pa.array([text]))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 35 * len(text)


def test_pieces_cover_documents_and_sequences(spark, tokenizer):
    rows = pack(documents(spark), keep_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"] > 0
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for (doc_id, _), own in by_doc.items():
        own.sort()
        joined = [x for _, part in own for x in part]
        texts = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in TEXTS if i == doc_id]
        texts = [t for t in texts if len(t) == sum(len(p) for _, p in own) // max(1, sum(len(x) == len(t) for x in texts))]
        assert joined == texts[0] if len(texts) == 1 else len(joined) == sum(map(len, texts))
    assert len(by_doc) == len({(i, t) for i, t in TEXTS})
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert set(by_sequence) == set(range(len(by_sequence)))


def test_little_padding(spark):
    rng = np.random.default_rng(3)
    texts = [(i, "word " * int(n)) for i, n in enumerate(rng.integers(5, 3000, 2000))]
    rows = pack(documents(spark, texts)).select("length", "sequence_id").toPandas()
    assert rows["length"].sum() / (2048 * rows["sequence_id"].nunique()) > 0.98


def test_empty_table(spark):
    assert pack(documents(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_every_piece_is_placed(seed):
    rng = np.random.default_rng(seed)
    capacity = 2048 // QUANTUM
    sizes = np.sort(rng.choice(np.arange(1, capacity + 1), rng.integers(1, 60), replace=False))
    demand = rng.integers(1, 10 ** int(rng.integers(1, 6)), len(sizes))
    plan = solve(sizes, demand, capacity)
    assert (sum(n * p for n, p in plan) == demand).all()
    assert all((p * sizes).sum() <= capacity and n > 0 for n, p in plan)
