"""Small document tables with everything that may go wrong in them."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for themselves.
CLASHES = "score double, kept boolean, row long, h long, part int, shard int, slot long, size long, rank long, words string, rejected boolean, key string, `a.b` string, `odd ``name` int"
N_CLASHES = len(CLASHES.split(","))


def prose(seed: int, n: int, words: int = 300) -> str:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(words)]
    return " ".join(rng.choices(vocabulary, k=n))


LONG = prose(7, 30_000)
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b"),
    (4, "a b"),
    (5, "a \t b"),
    (6, "A B"),
    (6, "A B"),
    (None, "no id but some words"),
    (None, None),
    (8, LONG),
    (9, LONG + " end"),
    (10, "ÀÉ ü 中文 テスト ß"),
    (11, prose(1, 60)),
    (12, prose(1, 60)),
    (13, prose(1, 60).replace(" ", "  ")),
    (14, "same words " * 40),
    (15, "\n".join([prose(2, 20)] * 5)),
    (16, "nul\x00 byte " + prose(3, 30)),
    (17, prose(1, 60) + " " + prose(5, 40)),
]


def documents(spark, texts=TEXTS, clashing: bool = True):
    rows = [(i, t, None if n % 3 == 0 else "xy"[n % 2], None, None if t is None else len(t)) for n, (i, t) in enumerate(texts)]
    if not clashing:
        return spark.createDataFrame(rows, COLUMNS)
    return spark.createDataFrame([r + (None,) * N_CLASHES for r in rows], f"{COLUMNS}, {CLASHES}")


def ids(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
