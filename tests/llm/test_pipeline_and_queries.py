"""Registered queries against their SQL, and the pipeline against a plain version of each stage."""

import os

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from tests.llm.frames import documents, prose
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_exact_dedup import brute as copies
from tests.llm.test_multiset_prints import brute as edited
from tests.llm.test_near_copies import smallest
from tests.llm.test_spelling import brute_variants, brute_words, held
from tests.oracle import compare, connect
from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
found = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not found")


def test_names():
    assert [int(n.split("_")[0][2:]) for n in QUERIES] == list(range(1, len(QUERIES) + 1)) and set(ORACLES) < set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())


@found
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


@found
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op12_partenum_spelling"}))
def test_query_gives_every_document(spark, name):
    rows = QUERIES[name](spark, FOLDER).select("doc_id").distinct().count()
    assert rows == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


@found
def test_spelling_query_by_brute_force(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = QUERIES["op12_partenum_spelling"](spark, FOLDER)
    assert held(found, *found.columns) == brute_variants(brute_words(texts))


@found
def test_fingerprint_query_by_brute_force(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = QUERIES["op11_multiset_fingerprints"](spark, FOLDER)
    assert held(found, "doc_id", "n_chars", "edited_sha256") == sorted((r[:3] for r in edited(texts)), key=repr)


def test_pipeline_by_brute_force(spark, tmp_path):
    item = prose(31, 40)
    texts = [(i, prose(1000 + i, 80)) for i in range(40)]
    texts += [(50 + i, prose(1000 + i, 80).replace(" ", " \n ")) for i in range(5)]
    texts += [(60, f"{prose(1100, 30)} {item}"), (61, prose(1200, 900)), (62, "1 2 3 !!"), (63, None), (64, "")]
    texts += [(70 + i, f"{prose(1200, 900)} tail{'ab'[i]}") for i in range(2)]
    changed = prose(1300, 200).split()
    texts.append((80, " ".join(changed)))
    changed[40] = changed[120] = "altered"
    texts.append((81, " ".join(changed)))
    documents(spark, texts).drop("lang").selectExpr("*", "'xx' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [(i, t) for i, t in texts if t and any(c.isalpha() for c in t)]
    stay = {i for i, _, _, kept, _ in copies(left) if kept}
    left = [(i, t) for i, t in left if i in stay]
    stay = {i for i, root in smallest(left).items() if i == root}
    left = [(i, t) for i, t in left if i in stay]
    stay = {i for i, *_, bad in contaminated(left, [(1, item)]) if not bad}
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == stay and not stay & {60, 70, 71, 81} and {61, 80} <= stay and len(stay) >= 41
    tokens = {}
    for r in rows:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    assert all(tokens[r["doc_id"]] == r["doc_tokens"] for r in rows)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
