"""Forests as tables of nodes, class dictionaries, and labels that are none."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.prep import class_dictionary, dense_class_ids
from tidemark.operators import training
from tidemark.operators.training import forest_predictions, forest_table, score_forest, train_forest, train_logreg


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    out = [(i, float(a), float(b), int(a + b > 0) + int(a > 1)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    return spark.createDataFrame(out, "id int, a double, b double, y int").repartition(3).cache()


def test_walking_the_table_equals_the_trainer(spark, rows):
    model = train_forest(rows, ["a", "b"], "y", trees=15)
    nodes = forest_table(model, spark, [0, 1, 2], "f", 4).unionByName(forest_table(model, spark, [7, 8, 9], "f", 5)).cache()
    assert nodes.select("tree").distinct().count() == 15
    mine = {r["id"]: r for r in score_forest(rows, nodes, ["a", "b"], "f", 4).collect()}
    for r in forest_predictions(model, rows, ["a", "b"]).collect():
        assert mine[r["id"]]["predicted_class"] == r["predicted_class"]
        assert mine[r["id"]]["prediction_probability"] == pytest.approx(r["prediction_probability"], abs=1e-12)
    other = {r["id"]: r["predicted_class"] for r in score_forest(rows, nodes, ["a", "b"], "f", 5).collect()}
    assert other == {i: r["predicted_class"] + 7 for i, r in mine.items()}
    with pytest.raises(ValueError, match="no version 6"):
        score_forest(rows, nodes, ["a", "b"], "f", 6)


def test_forest_rows_without_a_feature_and_large_forests(spark, rows, monkeypatch):
    nodes = forest_table(train_forest(rows, ["a", "b"], "y", trees=3, max_depth=2), spark, [0, 1, 2]).cache()
    odd = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, float("inf"), 1.0), (4, 0.0, 0.0)], "id int, a double, b double")
    found = {r["id"]: r["predicted_class"] for r in score_forest(odd, nodes, ["a", "b"]).collect()}
    assert [i for i, c in found.items() if c is not None] == [4]
    assert score_forest(odd.limit(0), nodes, ["a", "b"]).count() == 0
    monkeypatch.setattr(training, "FOREST_BYTES", 10)
    with pytest.raises(ValueError, match="too many"):
        score_forest(odd, nodes, ["a", "b"])


@pytest.mark.parametrize("labels", [[0.2, 1.4, 1.6], ["a", "b", "a"]])
def test_labels_must_be_whole_numbers(spark, labels):
    df = spark.createDataFrame([(float(i), y) for i, y in enumerate(labels)], ["a", "y"])
    with pytest.raises(ValueError, match="whole numbers"):
        train_logreg(df, ["a"], "y")


def test_whole_doubles_are_labels_and_missing_ones_are_left_out(spark):
    df = spark.createDataFrame([(0.0, 3.0), (0.1, 3.0), (2.0, 5.0), (2.1, 5.0), (9.0, None)], "a double, y double")
    assert train_logreg(df, ["a"], "y").class_ids == (3, 5)


def test_values_that_are_no_classes(spark, monkeypatch):
    monkeypatch.setattr(training, "MAX_CLASSES", 10)
    with pytest.raises(ValueError, match="no class label"):
        train_logreg(spark.range(50).selectExpr("id / 7 AS a", "id AS y"), ["a"], "y")


def test_dictionary_numbers_all_labels_in_order(spark):
    rng = random.Random(2)
    labels = sorted({rng.randrange(10**6) for _ in range(3000)})
    rows = [(i, rng.choice(labels) if i % 3 else labels[0]) for i in range(9000)] + [(9000 + i, y) for i, y in enumerate(labels)] + [(-1, None)]
    df = spark.createDataFrame(rows, "id int, y int").repartition(7)
    found = {r["y"]: r["class_id"] for r in class_dictionary(df, "y").collect()}
    assert found == {y: n for n, y in enumerate(labels)}
    ids = dense_class_ids(df, "y")
    assert ids.count() == len(rows) and ids.filter("y IS NULL AND class_id IS NULL").count() == 1
    assert ids.filter(F.col("class_id") == 0).select("y").distinct().collect()[0]["y"] == labels[0]
    words = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "y string")
    assert sorted((r["y"] or "", r["class_id"]) for r in dense_class_ids(words, "y").collect()) == [("", None), ("a", 0), ("b", 1), ("b", 1)]
    assert class_dictionary(words.filter("y IS NULL"), "y").count() == 0
