"""Every registered query against its SQL, and a stable row count for the rest."""

import os

import pytest

import __spark_entry__ as registered
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not found")

# the training-data operators have their own tests
QUERIES = {n: q for n, q in registered.queries().items() if n not in registered.LLM_QUERIES}
SQL = {n: q for n, q in registered.oracle_sql().items() if n not in registered.LLM_QUERIES}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"train_logreg", "train_logreg_coefficients", "train_forest"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    assert compare(QUERIES[name](spark, FOLDER), db, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert registered.entry(spark).count() > 0
