"""Forests grown by Spark jobs: above and in the subtrees, beside the trainer that keeps all nodes on the driver."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators import forests, training
from tidemark.operators.training import forest_predictions, forest_table, score_forest, train_forest


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 6)).round(3)
    y = (x[:, 0] + x[:, 1] > 0).astype(int) + (x[:, 2] > 0.7)
    rows = [(i, [float(c) for c in v], int(c)) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, v array<double>, y int").repartition(4, "id").cache()


def _walked(rows, nodes):
    """class shares of each row, by plain loops over the table."""
    by = {(n["tree"], n["node"]): n for n in nodes.collect()}
    trees = {t for t, _ in by}
    out = {}
    for r in rows.collect():
        total = 0
        for t in trees:
            n = by[t, 0]
            while n["feature"] >= 0:
                n = by[t, n["left"] if r["v"][n["feature"]] <= n["threshold"] else n["right"]]
            total = total + np.array(n["share"])
        out[r["id"]] = total / total.sum()
    return out


@pytest.mark.parametrize("local", [10_000, 60])
def test_all_ways_to_score_agree(spark, vectors, monkeypatch, local):
    monkeypatch.setattr(forests, "LOCAL_ROWS", local)
    monkeypatch.setattr(forests, "HISTOGRAM_BYTES", 40_000)
    model = train_forest(vectors, ["v"], "y", trees=7)
    assert (len(model.top.tree) > 7 * 5) == (local == 60)
    table = forest_table(model, spark, [0, 1, 2]).cache()
    numbers = table.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("node").alias("d"), F.min("node").alias("low"), F.max("node").alias("high")).collect()
    assert len(numbers) == 7 and all(r["n"] == r["d"] == r["high"] + 1 and r["low"] == 0 for r in numbers)
    expected = _walked(vectors, table)
    # as many trees at once as there is room for: here one or two
    most = table.groupBy("tree").count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(training, "TOGETHER_BYTES", int(most * 48 * 1.5))
    for found in (forest_predictions(model, vectors, ["v"]), score_forest(vectors, table, ["v"])):
        rows = found.collect()
        assert len(rows) == 900
        for r in rows:
            assert r["prediction_probability"] == pytest.approx(expected[r["id"]].max(), abs=1e-12)
            assert r["predicted_class"] == int(expected[r["id"]].argmax())


def test_leaves_are_pure_and_as_deep_as_allowed(spark, vectors):
    leaves = forest_table(train_forest(vectors, ["v"], "y", trees=5), spark, [0, 1, 2]).where("feature < 0")
    # bins may leave a mixed leaf only where no feature tells its rows apart
    assert leaves.where(F.array_max("share") < 1).count() <= 0.05 * leaves.count()
    shallow = forest_table(train_forest(vectors, ["v"], "y", trees=5, max_depth=2), spark, [0, 1, 2])
    assert shallow.groupBy("tree").count().agg(F.max("count")).first()[0] <= 7
    big = forest_table(train_forest(vectors, ["v"], "y", trees=5, min_leaf=100), spark, [0, 1, 2])
    assert big.groupBy("tree").count().agg(F.max("count")).first()[0] <= 2 * 9


def test_as_good_as_the_trainer_on_the_driver(spark, vectors, monkeypatch):
    monkeypatch.setattr(forests, "LOCAL_ROWS", 150)
    held = F.col("id") % 4 == 0
    model = train_forest(vectors.where(~held), ["v"], "y", trees=30)
    mine = forest_predictions(model, vectors.where(held), ["v"]).agg(F.avg((F.col("y") == F.col("predicted_class")).cast("double"))).first()[0]
    rows = vectors.withColumn("f", array_to_vector("v"))
    other = RandomForestClassifier(featuresCol="f", labelCol="y", numTrees=30, maxDepth=30, seed=1).fit(rows.where(~held))
    theirs = other.transform(rows.where(held)).agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0]
    assert mine > theirs - 0.04 and mine > 0.85


def test_nodes_of_many_rows_do_not_go_to_one_task(spark, vectors, monkeypatch):
    """A trainer that gives whole trees to a task, or all nodes to the driver, has no bound on a subtree's rows."""
    monkeypatch.setattr(forests, "LOCAL_ROWS", 60)
    model = train_forest(vectors, ["v"], "y", trees=4)
    roots = model.nodes.where("node = 0").select("sub").distinct().count()
    assert roots > 4 * 900 // 60 // 2
    open_ = [c.sum() for f, c in zip(model.top.feature, model.top.counts) if f < 0 and (c > 0).sum() > 1]
    assert max(open_) <= 60


@pytest.mark.parametrize("row", [(1, [1.0, None], 0), (1, [1.0, float("nan")], 0), (1, None, 0), (1, [1.0], 0), (1, [1.0, 2.0], None), (1, [1.0, 2.0], -1)])
def test_rows_that_cannot_be_learnt_from(spark, row):
    df = spark.createDataFrame([(0, [0.0, 1.0], 1), row], "id int, v array<double>, y int")
    with pytest.raises(ValueError, match="a forest needs"):
        train_forest(df, ["v"], "y")


def test_equal_rows_and_few_values(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 5.0], i % 2) for i in range(40)] + [(99, [0.0, 5.0], 1)], "id int, v array<double>, y int")
    model = train_forest(df, ["v"], "y", trees=9)
    assert [t.tolist() for t in model.thresholds] == [[0.5], []]
    found = {r["id"]: r for r in forest_predictions(model, df, ["v"]).collect()}
    assert found[1]["predicted_class"] == 1 and found[0]["predicted_class"] == 0 == found[99]["predicted_class"]
