import random

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.frames import documents, prose
from tidemark.llm import near_copies
from tidemark.llm.words import LOWER


def shingles(text):
    w = bytes(LOWER[list((text or "").encode())]).split() if text else []
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def smallest(texts):
    """Smallest doc_id of each document's component, over all pairs."""
    sets, root = {i: shingles(t) for i, t in texts}, {i: i for i, _ in texts}
    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and 5 * len(x & y) >= 4 * len(x | y) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root


def near_texts():
    """Documents of which some have copies with a few changed words, chains of copies, and a line that most share."""
    rng, out = random.Random(5), [(1, None), (2, ""), (3, "A b C"), (4, "a B c"), (5, "a b"), (6, prose(8, 6))]
    line = prose(9, 30)
    for i in range(40):
        words = (prose(100 + i, rng.randint(20, 300)) + " " + line).split()
        for k in range(rng.randint(0, 5)):
            out.append((1000 + len(out), " ".join(words)))
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return out


def test_stage_finds_all_pairs_of_the_similarity(spark):
    texts = near_texts()
    docs, root = documents(spark, texts), smallest(texts)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {i for i, r in root.items() if i == r}
    assert 10 < sum(i != r for i, r in root.items()) < len(texts) - 20


def test_stage_on_an_empty_table_and_rows_without_id(spark):
    assert corpus_pipeline.near_dedup(spark, documents(spark, []), "").count() == 0
    assert corpus_pipeline.near_dedup(spark, documents(spark, [(None, "a b c"), (None, "a b c"), (1, "a b c")]), "").count() == 3


def test_no_pair_is_lost_where_documents_share_lines(spark):
    """Documents made of lines of a common stock, all apart: their similar pairs are met, most others are not."""
    rng, stock = random.Random(11), [prose(500 + i, 14) for i in range(30)]
    texts = []
    for i in range(90):
        lines = rng.sample(stock, 6) + [prose(900 + i, rng.randint(5, 25))]
        texts.append((len(texts), " ".join(lines)))
        if i % 3 == 0:
            texts.append((len(texts), " ".join(lines[:-1] + [prose(2000 + i, rng.randint(3, 12))])))
    sets = {i: shingles(t) for i, t in texts}
    similar = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    entries = near_copies._prefixes(documents(spark, texts).select("doc_id", "text")).withColumn("root", F.col("doc_id"))
    met = [tuple(r) for r in near_copies._still_apart(entries).collect()]
    assert len(met) == len(set(met)) and len(similar) > 5
    assert similar <= set(met) and len(met) < 4 * len(similar) + 50


def test_fingerprints_fetch_the_first_candidates(spark, monkeypatch):
    base = prose(77, 900).split()
    changed = base[:400] + ["edit"] + base[401:]
    texts = [(1, " ".join(base)), (2, " ".join(changed)), (3, "  ".join(base)), (4, prose(78, 900)), (5, None), (6, ""), (7, " ")]
    docs = documents(spark, texts)
    prints = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in near_copies.fingerprinted(docs, near_copies.SHINGLE).collect()}
    close = {(a, b) for a in prints for b in prints if a < b and prints[a] and prints[b] and (prints[a] ^ prints[b]).bit_count() <= 2}
    found = {tuple(r) for r in near_copies._fetched(docs.select("doc_id", "text")).collect()}
    assert (1, 3) in found <= close
    seen = []
    real = near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda docs, pairs: (seen.append({tuple(r) for r in pairs.collect()}), real(docs, pairs))[1])
    assert {r[0] for r in near_copies.without_similar(docs).select("doc_id").collect()} == {1, 4, 5, 6, 7}
    assert found <= seen[0]  # all that fingerprints fetch is compared exactly


def test_fetching_candidates_broadcasts_no_exploded_rows(spark):
    """Spark sizes the Hamming balls as the fingerprints they are around; only sorting joins them."""
    docs = documents(spark, [(i, prose(8000 + i, 12)) for i in range(300)], clashing=False).select("doc_id", "text")
    lines = near_copies._fetched(docs)._jdf.queryExecution().executedPlan().toString().split("\n")
    balls = [i for i, line in enumerate(lines) if "Generate explode" in line]
    assert balls
    for i in balls:
        depth = lines[i].index("Generate")
        for line in reversed(lines[:i]):
            at = next(k for k, c in enumerate(line) if c.isupper())
            if at < depth:
                depth = at
                if "Join" in line or line[at:].startswith("Broadcast"):
                    assert line[at:].startswith("SortMergeJoin")
                    break
