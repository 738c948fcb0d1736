import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import scoring
from tidemark.operators.scoring import LinearModel
from tidemark.operators.training import forest_predictions, train_forest, train_logreg
from tidemark.sources.tables import SMOKE_FEATURES, smoke_rows

RNG = np.random.default_rng(11)
MODEL = LinearModel(
    "m", 4, ("a", "b"), (0, 1, 2), (0.1, 0.0, -0.3), ((1.0, -2.0), (0.5, 0.5), (-1.0, 3.0))
)


def softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_score_matches_numpy(spark):
    x = RNG.normal(size=(200, 2)) * 50
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double")
    scales = {"a": (1.0, 2.0), "b": (-3.0, 0.5)}
    rows = scoring.score(df, MODEL, scales).orderBy("id").collect()
    z = (x - [1.0, -3.0]) / [2.0, 0.5] @ np.array(MODEL.weights).T + MODEL.intercepts
    p = softmax(z)
    for row, probabilities, raw in zip(rows, p, x):
        got = [row[f"probability_class_{c}"] for c in range(3)]
        assert got == pytest.approx(probabilities, abs=1e-12) and sum(got) == pytest.approx(1)
        assert row["predicted_class"] == probabilities.argmax() and row["model_version"] == 4
        assert row["prediction_probability"] == max(got) and row["a"] == raw[0]


def test_a_filter_on_a_score_does_not_repeat_the_arithmetic(spark):
    df = spark.createDataFrame([(i, float(i), -float(i), None if i % 2 else i) for i in range(6)], "id long, a double, b double, `x.y` long")
    scored = scoring.score(df, MODEL, {"a": (1.0, 2.0), "b": (-3.0, 0.5)})
    kept = scored.filter("prediction_probability > 0.5 AND id > 0")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("EXP(") == 3 and plan.count("/ 0.5)") == 1  # one for each class, one view of a feature
    assert "(id#" in plan.split("Generate")[1]  # other conditions still go below
    assert scored.columns[:4] == df.columns and scored.count() == 6
    assert kept.count() == sum(r["prediction_probability"] > 0.5 and r["id"] > 0 for r in scored.collect())


def test_ties_and_missing_features(spark):
    flat = LinearModel("m", 1, ("a",), (3, 5), (0.0, 0.0), ((0.0,), (0.0,)))
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "a double")
    rows = scoring.score(df, flat).collect()
    assert [r["predicted_class"] for r in rows] == [3, None, None]
    assert [r["prediction_probability"] for r in rows] == [0.5, None, None]


def test_wide_and_unrolled_agree(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 2.0), (-4.0, 0.5), (None, 1.0)], "a double, b double")
    unrolled = scoring.score(df, MODEL, {"a": (0.0, 2.0), "b": (1.0, 1.0)}).collect()
    monkeypatch.setattr(scoring, "UNROLL_LIMIT", 0)
    batched = scoring.score(df, MODEL, {"a": (0.0, 2.0), "b": (1.0, 1.0)}).collect()
    for one, two in zip(unrolled, batched):
        assert one["predicted_class"] == two["predicted_class"]
        for c in range(3):
            assert one[f"probability_class_{c}"] == pytest.approx(two[f"probability_class_{c}"])


def test_scoring_function_over_struct(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-4.0, 0.5)], "a double, b double")
    rows = df.withColumn("p", scoring.probability_udf(MODEL)(F.struct("a", "b"))).collect()
    z = np.array([[1.0, 2.0], [-4.0, 0.5]]) @ np.array(MODEL.weights).T + MODEL.intercepts
    assert [r["p"] for r in rows] == [pytest.approx(p) for p in softmax(z)]


def test_model_table_round_trip(spark):
    table = MODEL.to_table(spark)
    assert LinearModel.from_table(table, "m", 4) == MODEL
    with pytest.raises(ValueError, match="no version 9"):
        LinearModel.from_table(table, "m", 9)


def test_rows_that_name_their_model(spark):
    table = MODEL.to_table(spark).unionByName(
        LinearModel("other", 4, ("a", "b"), (0, 1), (0.0, 1.0), ((0.0, 0.0), (0.0, 0.0))).to_table(spark)
    )
    df = spark.createDataFrame([("m", 1.0, 2.0), ("other", 1.0, 2.0), ("unknown", 1.0, 2.0)], "model_name string, a double, b double")
    rows = {r["model_name"]: r for r in scoring.score_by_row_model(df, table, ["model_name"], ["a", "b"]).collect()}
    alone = scoring.score(df, MODEL).first()
    assert rows["m"]["predicted_class"] == alone["predicted_class"]
    assert rows["m"]["probabilities"] == pytest.approx([alone[f"probability_class_{c}"] for c in range(3)])
    assert rows["other"]["predicted_class"] == 1
    assert rows["unknown"]["predicted_class"] is None and rows["unknown"]["prediction_probability"] is None


def test_alignment(spark):
    original = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id int, x double")
    predictions = spark.createDataFrame([(3, 1), (1, 0), (2, 2)], "id int, predicted_class int")
    rows = {r["id"]: (r["x"], r["predicted_class"]) for r in scoring.align_predictions(original, predictions, ["id"]).collect()}
    assert rows == {1: (10.0, 0), 2: (20.0, 2), 3: (30.0, 1)}
    missing = scoring.align_predictions(original, predictions.filter("id > 1"), ["id"]).filter("id = 1").first()
    assert missing["x"] == 10.0 and missing["predicted_class"] is None
    with pytest.raises(ValueError, match="both tables"):
        scoring.align_predictions(original, original, ["id"])
    scoring.require_aligned(original, predictions, ["id"])
    with pytest.raises(ValueError, match="align"):
        scoring.require_aligned(original, predictions.union(predictions), ["id"])
    joined, lost = scoring.join_labels(original, predictions.filter("id < 3").select("id", "predicted_class"), ["id"])
    assert joined.count() == 2 and [tuple(r) for r in lost.collect()] == [(3, "features")]


def blobs(spark, classes, per_class=60):
    rows = []
    for c in classes:
        for x in RNG.normal(loc=(c, -c, c * 0.5, 1), scale=0.8, size=(per_class, 4)):
            rows.append((*map(float, x), int(c)))
    return spark.createDataFrame(rows, ", ".join(f"{f} double" for f in SMOKE_FEATURES) + ", target int")


@pytest.mark.parametrize("classes", [(0, 1, 2), (3, 8)])
def test_logistic_regression_minimises_the_stated_objective(spark, classes):
    df = blobs(spark, classes)
    model = train_logreg(df, SMOKE_FEATURES, "target", tol=1e-10, max_iter=500)
    assert model.class_ids == classes
    data = np.array([tuple(r) for r in df.collect()])
    x, y = data[:, :4], data[:, 4].astype(int)
    w, b = np.array(model.weights), np.array(model.intercepts)
    hot = (y[:, None] == np.array(classes)).astype(float)
    error = softmax(x @ w.T + b) - hot
    gradient = error.T @ x
    if len(classes) == 2:
        gradient, w = gradient[1:], w[1:]
    assert np.abs(gradient + w).max() < 1e-3
    assert np.abs(error.sum(axis=0)).max() < 1e-3
    accuracy = scoring.score(df, model).agg(F.avg((F.col("target") == F.col("predicted_class")).cast("double"))).first()[0]
    assert accuracy > 0.7


def test_training_errors_and_smoke_rows(spark):
    df = blobs(spark, (0, 1, 2), 20)
    with pytest.raises(ValueError, match="solver"):
        train_logreg(df, SMOKE_FEATURES, "target", solver="saga")
    with pytest.raises(ValueError, match="two classes"):
        train_logreg(df.filter("target = 1"), SMOKE_FEATURES, "target")
    model = train_logreg(df, SMOKE_FEATURES, "target")
    assert scoring.score(smoke_rows(spark), model).filter("predicted_class is null").isEmpty()


def test_forest(spark):
    df = blobs(spark, (0, 1, 2), 40)
    model = train_forest(df, SMOKE_FEATURES, "target", trees=10, max_depth=6)
    rows = forest_predictions(model, df, SMOKE_FEATURES)
    assert rows.columns == [*df.columns, "predicted_class", "prediction_probability"]
    right = rows.filter("target = predicted_class").count()
    assert right > 100 and rows.filter("prediction_probability between 0 and 1").count() == 120


def test_odd_inputs_have_no_score_either_way(spark):
    inf, nan = float("inf"), float("nan")
    wide = LinearModel("w", 1, ("v",), (0, 1, 2), (0.1, 0.0, -0.1), tuple(tuple(float(i + j) for j in range(4)) for i in range(3)))
    values = [[1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0], [1.0] * 5, [1.0, inf, 0.0, 0.0], [1.0, -inf, 0.0, 0.0], [1.0, nan, 0.0, 0.0], [1.0, None, 0.0, 0.0], [], None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v array<double>")
    for unroll in (0, 1000):
        found = {r["id"]: r for r in scoring.with_probabilities(rows, wide, unroll=unroll).collect()}
        assert [i for i, r in found.items() if r["predicted_class"] is not None] == [0]
        assert all(r["probability_class_1"] is None for i, r in found.items() if i)
    with pytest.raises(ValueError, match="scaler"):
        scoring.with_probabilities(rows, wide, {"v": (0.0, 1.0)})
