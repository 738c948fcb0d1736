import numpy as np
import pytest

from tidemark.operators import evaluate


def pairs(spark, y, p):
    return spark.createDataFrame(list(zip(y, p)), "y int, p int").repartition(3)


def metrics(spark, y, p):
    return evaluate.evaluate_predictions(pairs(spark, y, p), "y", "p").first()


def test_missing_predicted_class(spark):
    row = metrics(spark, [0, 1, 2], [0, 0, 0])
    assert row["precision"] == pytest.approx(1 / 9) and row["recall"] == pytest.approx(1 / 3)
    assert row["f1_score"] == pytest.approx(1 / 6) and row["accuracy"] == pytest.approx(1 / 3)
    counts = evaluate.confusion_counts(pairs(spark, [0, 1, 2], [0, 0, 0]), "y", "p")
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(counts).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 3 and cells[2, 1] == 0
    nested = evaluate.confusion_array(counts).first()
    assert nested["labels"] == [0, 1, 2] and nested["matrix"] == [[1, 0, 0], [1, 0, 0], [1, 0, 0]]


def test_class_only_in_predictions(spark):
    counts = evaluate.confusion_counts(pairs(spark, [0, 0], [0, 9]), "y", "p")
    report = {r["entry"]: r for r in evaluate.classification_report(counts).collect()}
    assert report["9"]["support"] == 0 and report["9"]["f1_score"] == 0.0
    assert report["macro avg"]["precision"] == pytest.approx(0.5)
    assert report["weighted avg"]["recall"] == pytest.approx(0.5) and report["accuracy"]["recall"] == 0.5


def test_report_names_and_flat_metrics(spark):
    counts = evaluate.confusion_counts(pairs(spark, [0, 1, 1], [0, 1, 0]), "y", "p")
    flat = evaluate.flatten_report(evaluate.classification_report(counts, {0: "Setosa", 1: "Versicolor"}))
    values = {r["metric"]: r["value"] for r in flat.collect()}
    assert values["Setosa_precision"] == 0.5 and values["Versicolor_recall"] == 0.5
    assert values["weighted avg_support"] == 3.0 and "accuracy_precision" not in values


def test_against_direct_computation(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 5, 4000), rng.integers(0, 6, 4000)
    y[:1500] = 3
    row = metrics(spark, y.tolist(), p.tolist())
    f1 = sum(
        (y == c).sum() * (2 * ((y == c) & (p == c)).sum() / max(1, (y == c).sum() + (p == c).sum())) for c in range(6)
    ) / len(y)
    assert row["accuracy"] == pytest.approx((y == p).mean()) and row["f1_score"] == pytest.approx(f1)


def test_roc_auc(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 600)
    scores = np.round(rng.dirichlet(np.ones(3), 600) + 0.2 * np.eye(3)[y], 2)
    scores[:200] = 0.33
    rows = [(int(a), *map(float, s)) for a, s in zip(y, scores)]
    df = spark.createDataFrame(rows, "y int, probability_class_0 double, probability_class_1 double, probability_class_2 double")
    found = evaluate.roc_auc(df.repartition(4), "y", [0, 1, 2])
    for row in found.collect():
        s = scores[:, row["class"]]
        pos, neg = s[y == row["class"]][:, None], s[y != row["class"]][None, :]
        assert row["auc"] == pytest.approx(((pos > neg) + 0.5 * (pos == neg)).mean(), abs=1e-12)
    assert 0 < evaluate.weighted_auc(found).first()["roc_auc"] < 1


def test_log_loss(spark):
    df = spark.createDataFrame([(0, 0.8, 0.2), (1, 0.6, 0.4), (1, 1.0, 0.0)], "y int, probability_class_0 double, probability_class_1 double")
    expected = -(np.log(0.8) + np.log(0.4) + np.log(1e-15)) / 3
    assert evaluate.log_loss(df, "y", [0, 1]).first()["log_loss"] == pytest.approx(expected)


def test_comparison(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 1, 0), (1, 0, 1), (1, 0, 1)], "y int, a int, b int")
    tie = evaluate.compare_predictions(df, "y", "a", "a").first()
    assert tie["winner"] == "production" and tie["improvement"] == 0.0
    row = evaluate.compare_predictions(df, "y", "a", "b").first()
    assert row["winner"] == "challenger" and row["improvement"] == pytest.approx(0.25)
    assert row["production_accuracy"] == 0.5 and row["challenger_accuracy"] == 0.75


def test_rows_without_label_are_not_judged(spark):
    df = spark.createDataFrame([(0, 0, 0.9, 0.1), (1, 1, 0.1, 0.9), (None, 0, 0.9, 0.1), (None, 1, 0.0, 1.0)], "y int, p int, probability_class_0 double, probability_class_1 double")
    row = evaluate.evaluate_predictions(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["f1_score"], row["total"]) == (1.0, 1.0, 1.0, 2)
    assert evaluate.log_loss(df, "y", [0, 1]).first()["log_loss"] == pytest.approx(-np.log(0.9))
    with pytest.raises(Exception, match="no probability for label 1"):
        evaluate.log_loss(df, "y", [0]).collect()
