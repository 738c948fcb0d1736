import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import TEXTS, documents
from tidemark.llm import language
from tidemark.llm.language import BEGIN, END, ORDER, CharModels, WordBag, _count_batches, held_out, identify, train

SYLLABLES = {"aa": ["ka", "to", "mi", "ne", "ru"], "bb": ["sch", "ung", "ein", "ver", "keit"], "cc": ["éa", "oux", "que", "tion", "ré"]}


def texts(n, words, seed=0):
    rng = random.Random(seed)
    return [(i, lang, " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))) for i in range(n) for lang in [rng.choice(sorted(SYLLABLES))]]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, True) for i, lang, t in rows], "doc_id long, text string, lang string, score int, rejected boolean")


def fit(rows):
    batch = pa.record_batch([pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], ["lang", "text"])
    return CharModels.fit(pa.Table.from_batches(list(_count_batches(iter([batch])))).to_pandas())


def slow_probability(counts, alphabet, history, char):
    """Interpolated Kneser-Ney of one language from its raw counts {n-gram: times}, by definition."""
    if not history and len(history) == 0 and char is None:
        return 1.0 / alphabet

    def adjusted(n):
        if n == ORDER:
            return {g: c for g, c in counts.items() if len(g) == n}
        out = {}
        for g in (g for g in counts if len(g) == n):
            out[g] = counts[g] if g[0] == BEGIN else sum(len(x) == n + 1 and x[1:] == g for x in counts)
        return out

    def p(history):
        n = len(history) + 1
        table = {g: c for g, c in tables[n].items() if g[:-1] == history}
        lower = p(history[1:]) if history else 1.0 / alphabet
        if not table:
            return lower
        ones, twos = sum(c == 1 for c in tables[n].values()), sum(c == 2 for c in tables[n].values())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.75
        total = sum(table.values())
        return max(table.get((*history, char), 0) - (discount if (*history, char) in table else 0), 0) / total + discount * len(table) / total * lower

    tables = {n: adjusted(n) for n in range(1, ORDER + 1)}
    return p(history)


def test_probabilities_follow_the_definition():
    rows = texts(12, 6)
    models = fit(rows)
    chars = {c for _, _, t in rows for c in t if c != " "}
    for column, lang in enumerate(models.languages):
        counts = {}
        for _, own, text in rows:
            for word in text.split() if own == lang else []:
                points = (BEGIN, *map(ord, word), END)
                for end in range(1, len(points)):
                    for n in range(1, min(ORDER, end + 1) + 1):
                        g = points[end - n + 1 : end + 1]
                        counts[g] = counts.get(g, 0) + 1
        for word in ("kato", "schein", "xyz", "tion", "k"):
            points = (BEGIN, *map(ord, word), END)
            slow = sum(np.log(slow_probability(counts, len(chars) + 2, points[max(0, i - ORDER + 1) : i], points[i])) for i in range(1, len(points)))
            scores, sizes = models.word_scores(WordBag.of(pa.array([word])))
            assert sizes[0] == len(word) + 1 and scores[0, column] == pytest.approx(slow, abs=1e-3)


def test_probabilities_sum_to_one():
    models = fit(texts(30, 20))
    seen = sorted({c for s in SYLLABLES.values() for x in s for c in x})
    # after "ka" every known character, the word's end, and one unknown
    bag = WordBag.of(pa.array([f"ka{c}" for c in seen] + ["ka", "kaж"]))
    place, hashes = bag.grams()
    assert len(models.grams) == len(models.log_p) and (np.diff(models.grams.astype(object)) > 0).all() and place.max() == 4


def test_held_out_accuracy(spark):
    rows = texts(600, 12)
    found = identify(table(spark, rows), ~held_out(4, 2)).toPandas().merge(pd.DataFrame(rows, columns=["doc_id", "lang", "text"]), on="doc_id")
    out = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in found["doc_id"]])
    assert out.sum() > 100 and (found["lang"] == found["lang_pred"])[out].mean() > 0.99
    assert found["score"].between(0, 1).all() and not found["rejected"][out].any()


def test_learns_nothing_from_held_out_rows(spark):
    rows = texts(200, 8)
    spoiled = [(i, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, t) for i, lang, t in rows]
    a, b = (identify(table(spark, r), ~held_out(4, 2)).orderBy("doc_id").collect() for r in (rows, spoiled))
    assert a == b


def test_rejects_foreign_text_and_text_without_letters(spark):
    junk = [(9001, None, "xqzjw vkpqx zzxqj wqkxz " * 8), (9002, None, "12 34 %% !!"), (9003, None, None), (9004, None, ""), (None, None, "kato mine")]
    found = {r["doc_id"]: r for r in identify(table(spark, texts(400, 30) + junk)).where("doc_id > 9000 OR doc_id IS NULL").collect()}
    assert found[9001]["rejected"] and not found[None]["rejected"] and found[None]["lang_pred"] == "aa"
    for i in (9002, 9003, 9004):
        assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0 and found[i]["rejected"]


def test_edge_tables(spark):
    docs = documents(spark)
    found = identify(docs, keep=True, prefix="__x_")
    assert found.count() == len(TEXTS) and set(docs.columns) <= set(found.columns)
    assert identify(documents(spark, [])).count() == 0
    unlabelled = identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlabelled} == {"und"} and len(unlabelled) == len(TEXTS)


def test_word_bag():
    bag = WordBag.of(pa.array(["Ab, ab! ß7x", None, "", "中文 ab"]))
    words = ["".join(map(chr, bag.points[a + 1 : b - 1])) for a, b in zip(bag.starts, bag.starts[1:])]
    assert [(words[c], t) for c, t in zip(bag.codes, bag.texts)] == [("ab", 0), ("ab", 0), ("ß", 0), ("x", 0), ("中文", 3), ("ab", 3)]
    assert language.ROOT == 1


def test_models_keep_every_gram_of_a_large_alphabet(spark):
    rng = random.Random(3)
    rows = [(i, "zh", " ".join("".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(4)) for _ in range(600))) for i in range(100)]
    models = train(table(spark, rows), F.lit(True)).models
    place, hashes = WordBag.of(pa.array([t for _, _, t in rows])).grams()
    for n in range(1, ORDER + 1):
        assert np.isin(hashes[n][place >= max(1, n - 1)], models.grams).all()
    assert len(np.unique(hashes[4][place >= 3])) > 1 << 17


def test_rejection_bounds_cover_all_rows(spark):
    rows = [r for r in texts(9000, 3) if r[1] != "cc"] + [(9000 + i, "cc", t) for i, _, t in [r for r in texts(60, 3, 1) if r[1] == "cc"][:3]]
    found = train(table(spark, rows), F.lit(True))
    entropy, length = found.models.text_scores(pa.array([t for *_, t in rows]))
    for i, lang in enumerate(found.models.languages):
        own = np.array([r[1] == lang for r in rows]) & (entropy.argmin(axis=1) == i)
        mean = entropy[own, i].mean()
        beyond = (entropy[own, i] - mean) * np.sqrt(np.minimum(length[own], language.SURE))
        assert found.usual[i] == pytest.approx(mean) and found.excess[i] == pytest.approx(max(1.0, np.quantile(beyond, language.CALIBRATION_SHARE)))
    assert np.isfinite(found.excess).all()


def test_the_driver_holds_columns_not_an_object_for_each_count(spark):
    rng = random.Random(4)
    rows = [(i, "xy"[i % 2], " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(60))) for i in range(200)]
    train(table(spark, rows[:4]), F.lit(True))  # modules are loaded
    tracemalloc.start()
    found = train(table(spark, rows), F.lit(True))
    peak, size = tracemalloc.get_traced_memory()[1], len(found.models.grams)
    tracemalloc.stop()
    assert size > 40_000 and peak < 400 * size, (size, peak)


def test_letters_are_found_without_a_list_of_all_characters():
    language._letters.cache_clear()
    tracemalloc.start()
    is_letter, lower = language._letters()
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 16 << 20
    assert lower.dtype == np.uint32 and is_letter.dtype == bool and len(is_letter) == len(lower) == 0x110000
    for point in [*range(0x3000), 0x4E2D, 0xD800, 0x10400, 0x10FFFF]:
        low = chr(point).lower()
        assert is_letter[point] == chr(point).isalpha() and lower[point] == (ord(low) if len(low) == 1 else point)
