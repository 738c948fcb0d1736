import random
import zlib

import pandas as pd

from tests.llm.frames import TEXTS, documents, prose
from tidemark.llm.language import held_out
from tidemark.llm.toxicity import score_toxicity

BAD = ["grubworm", "nastyhead", "foulmouth", "vilething", "rottenegg", "dirtbagger"]


def rows(n, seed=0):
    rng = random.Random(seed)
    vocabulary = prose(99, 3000).split()
    out = []
    for i in range(n):
        toxic = int(rng.random() < 0.25)
        words = rng.choices(vocabulary, k=rng.randint(60, 250))
        for _ in range(toxic * len(words) // 12):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        out.append((i, " ".join(words), toxic))
    return out


def labels(spark, known):
    return spark.createDataFrame(known, "doc_id long, toxic int").selectExpr("*", "1 AS quality", "'x' AS text")


def test_held_out_rows(spark):
    data = rows(900)
    docs = documents(spark, [(i, t) for i, t, _ in data])
    found = score_toxicity(docs, labels(spark, [(i, k) for i, _, k in data]), ~held_out(3, 1)).toPandas().merge(pd.DataFrame(data, columns=["doc_id", "text", "toxic"]), on="doc_id")
    out = found[[zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]]
    caught = out["score"] >= 0.7
    assert len(out) > 200 and found["score"].between(0, 1).all()
    assert caught[out["toxic"] == 1].mean() > 0.9 and caught[out["toxic"] == 0].mean() < 0.02


def test_labels_of_held_out_rows_do_not_matter(spark):
    data = rows(300, 4)
    docs = documents(spark, [(i, t) for i, t, _ in data])
    flipped = [(i, 1 - k if zlib.crc32(str(i).encode()) % 3 == 1 else k) for i, _, k in data]
    a, b = (score_toxicity(docs, labels(spark, known), ~held_out(3, 1)).orderBy("doc_id").collect() for known in ([(i, k) for i, _, k in data], flipped))
    assert a == b


def test_edge_tables(spark):
    known = [(1, 1), (2, 0), (4, 0), (8, 1), (9, 0), (9, 1), (11, 0), (14, None), (15, 7), (None, 1), (999, 1)]
    found = score_toxicity(documents(spark), labels(spark, known)).collect()
    assert len(found) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in found)
    assert score_toxicity(documents(spark, []), labels(spark, known)).count() == 0
    nothing = score_toxicity(documents(spark), labels(spark, [])).collect()
    assert len(nothing) == len(TEXTS) and max(r["score"] for r in nothing) < 1e-9
