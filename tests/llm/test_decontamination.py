import hashlib
import re

from tests.llm.frames import LONG, TEXTS, documents, ids, prose
from tidemark.llm.decontamination import contamination, without_contaminated

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [
    (1, " ".join(prose(1, 60).split()[10:40])),
    (2, "A, b!"),
    (3, None),
    (4, ""),
    (5, " ".join(LONG.split()[500:513])),
    (6, " ".join(LONG.split()[500:513])),
    (7, "words"),
    (None, " ".join(prose(5, 40).split()[:20])),
    (8, "same words " * 30),
    (10, "中文 テスト ß"),
    (11, " ".join(prose(99, 50).split())),
    (12, " ".join(prose(1, 60).split()[3:9]) + " zzz"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, items):
    out = []
    for doc_id, text in texts:
        w, hit, found = words(text), set(), set()
        for item, other in items:
            v = words(other)
            m = min(13, len(v))
            grams = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if v else set()
            at = [i for i in range(len(w) - m + 1) if tuple(w[i : i + m]) in grams] if v else []
            if at:
                found.add("" if item is None else str(item))
            hit |= {p for i in at for p in range(i, i + m)}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, None, 1) for i, t in items], "item_id long, text string, words string, h long")


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_brute_force(spark):
    assert ids(contamination(documents(spark), benchmark(spark)), *COLUMNS) == brute(TEXTS, ITEMS)


def test_every_span_length_is_found(spark):
    """Shared spans of 12 words or fewer are no hit, 13 and more always are, wherever they lie."""
    item = prose(21, 80).split()
    texts = []
    for n in range(10, 30):
        for at in (0, 1, 7, 30):
            filler = prose(1000 + n * 7 + at, 40).split()
            texts.append((len(texts), " ".join(filler[:at] + item[at : at + n] + filler[at:])))
    items = [(1, " ".join(item))]
    assert ids(contamination(documents(spark, texts), benchmark(spark, items)), *COLUMNS) == brute(texts, items)


def test_empty_tables(spark):
    assert contamination(documents(spark, []), benchmark(spark)).count() == 0
    assert ids(contamination(documents(spark), benchmark(spark, [])), *COLUMNS) == brute(TEXTS, [])


def test_filter(spark):
    docs = documents(spark)
    kept = without_contaminated(docs, benchmark(spark))
    assert kept.columns == docs.columns
    assert sorted((r[0] for r in kept.select("doc_id").collect()), key=repr) == sorted((i for i, *_, bad in brute(TEXTS, ITEMS) if not bad), key=repr)
