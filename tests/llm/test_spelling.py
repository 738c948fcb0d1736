import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.frames import TEXTS, documents, prose
from tidemark.llm import spelling
from tidemark.llm.spelling import _signatures, corpus_words, near_words, spelling_variants


def brute_words(texts, damage=199, min_length=6, min_count=5):
    counts = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if damage and h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def brute_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    near = {w: [o for o in counts if brute_near(w, o)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, counts[w], len(near[w]), counts[forms[w]] if forms[w] else None))
    return sorted(out, key=repr)


def misspelt(seed, words, letters="abcdeéÿ"):
    """Counts of words over few letters, so that many are near each other, and of words at all lengths."""
    rng = random.Random(seed)
    counts = {}
    while len(counts) < words:
        w = "".join(rng.choices(letters, k=rng.choice([1, 2, 5, 6, 7, 7, 8, 12])))
        for _ in range(3):
            counts[w] = rng.choice([1, 5, 6, 25, 26, 150, 900, 30_000])
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :], w[:at] + w[at + 1 :] or "a"])
    return counts


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def held(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("crowd", [0, 3, 64])
def test_variants_by_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    counts = misspelt(crowd, 500)
    found = spelling_variants(frame(spark, counts).repartition(5))
    assert held(found, *COLUMNS) == brute_variants(counts)


@pytest.mark.parametrize("first,second", [(1, 4), (1, 7), (2, 3), (3, 1), (3, 2)])
def test_near_words_share_a_signature(spark, first, second):
    """The guarantee of partition and enumeration, for several layouts."""
    counts = misspelt(5, 150)
    elements, hashes, keys = _signatures("word", first, second)
    from unittest.mock import patch

    with patch.object(spelling, "FIRST", first), patch.object(spelling, "SECOND", second):
        rows = frame(spark, counts).withColumn("__e", elements).withColumn("__h", hashes).select("word", keys.alias("keys")).collect()
    signatures = {r["word"]: set(r["keys"]) for r in rows}
    pairs = [(a, b) for a in counts for b in counts if a < b and brute_near(a, b)]
    assert len(pairs) > 50 and all(signatures[a] & signatures[b] for a, b in pairs)


def test_chain_of_forms_is_followed_to_its_end(spark):
    counts = {"a" * 6 + "b" * i: 5 * 5**i for i in range(12)}
    found = {r["word"]: r["root"] for r in spelling_variants(frame(spark, counts)).collect()}
    assert set(found.values()) == {"a" * 6 + "b" * 11}


def test_one_word_with_many_variants_and_one_signature(spark):
    """A third of all words are near one word; another third are anagrams of each other."""
    rng = random.Random(3)
    counts = {"horizontal": 10_000}
    while len(counts) < 150:
        at = rng.randrange(10)
        counts["horizontal"[:at] + rng.choice("abcdefghijklmnopqrstuvwxyzàé") + "horizontal"[at + 1 :]] = rng.choice([5, 5000])
    while len(counts) < 300:
        counts["".join(rng.sample("aaabbbccdd", 10))] = 7
    counts |= {w: 8 for w in set(prose(9, 150).split())}
    assert held(spelling_variants(frame(spark, counts)), *COLUMNS) == brute_variants(counts)


@pytest.mark.parametrize("damage", [None, 2, 199])
def test_words_by_brute_force(spark, damage):
    texts = TEXTS + [(i, prose(i % 3, 200).title() + " Été ÉTÉ œuvre naïve×÷ naïveté's 12ab34 ſharp") for i in range(100, 130)]
    found = corpus_words(documents(spark, texts).repartition(6), damage=damage)
    assert held(found, "word", "n") == sorted(brute_words(texts, damage).items(), key=repr)


def test_tasks_send_counts_on_and_texts_are_read_in_parts(spark, monkeypatch):
    texts = [(i, prose(i % 4, 3000)) for i in range(8)]
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    monkeypatch.setattr(spelling, "PART", 100)
    assert held(corpus_words(documents(spark, texts), damage=7), "word", "n") == sorted(brute_words(texts, 7).items(), key=repr)


def test_empty_tables_and_odd_words(spark):
    assert corpus_words(documents(spark, [])).count() == 0
    assert spelling_variants(frame(spark, {})).count() == 0
    odd = spark.createDataFrame([(None, 5), ("", 9), ("a", 50)], "word string, n long")
    assert held(spelling_variants(odd), *COLUMNS) == [("", "a", "a", 9, 1, 50), ("a", None, "a", 50, 1, None)]
    with pytest.raises(ValueError):
        spelling_variants(odd, ratio=1)
    assert near_words(odd.where("word is null")).count() == 0
