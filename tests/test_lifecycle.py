import uuid
from datetime import date, datetime

import numpy as np
import pytest

from tidemark.operators.prep import normalize_names, range_rules
from tidemark.plans.lifecycle import METRICS, PARAMS, Lifecycle
from tidemark.sources import predictions as history
from tidemark.sources.tables import SMOKE_FEATURES, TableSpace, smoke_rows
from tidemark.sources.workspace import Summary


@pytest.fixture
def raw(spark):
    rng, rows = np.random.default_rng(0), []
    for c, mu in enumerate([(5.0, 3.4, 1.5, 0.3), (5.9, 2.8, 4.3, 1.3), (6.6, 3.0, 5.5, 2.0)]):
        rows += [(c * 50 + i, *map(float, np.abs(rng.normal(mu, 0.4))), c) for i in range(50)]
    names = ", ".join(f"`{f.replace('_cm', ' (cm)').replace('_', ' ')}` double" for f in SMOKE_FEATURES)
    return spark.createDataFrame(rows, f"id long, {names}, target int")


def test_whole_lifecycle(spark, raw):
    space = TableSpace(spark, f"t{uuid.uuid4().hex}").create()
    job = Lifecycle(space, "flowers", SMOKE_FEATURES)
    rules = range_rules({f: (0, None) for f in SMOKE_FEATURES})
    job.prepare(raw, ["id"], rules=rules)
    assert space.read("train").count() == 120 and space.read("test").count() == 30

    first = job.train(max_iter=2)
    assert first.version == 1
    logged = {r["metric"]: r["value"] for r in space.read(METRICS).collect()}
    settings = {r["param"]: r["value"] for r in space.read(PARAMS).filter("version = 1").collect()}
    assert settings["solver"] == "lbfgs" and settings["max_iter"] == "2" and settings["label"] == "target"
    assert set(logged) == {f"train_{m}" for m in ("accuracy", "precision", "recall", "f1_score", "log_loss", "roc_auc")} | {"test_accuracy"}
    assert 0.5 < logged["train_roc_auc"] <= 1 and logged["train_log_loss"] > 0
    assert job.compare().first()["status"] == "no_production"
    job.promote()  # no challenger, nothing happens
    assert job.alias_log().count() == 1
    job.promote(only_if_better=False, from_alias="baseline")
    assert job.evaluate_alias("production").first()["version"] == 1
    with pytest.raises(ValueError, match="no alias 'baseline'"):
        job.evaluate_alias("baseline")

    second = job.train(ts=datetime(2024, 1, 1))
    assert second.version == 2
    comparison = job.compare().first()
    assert comparison["status"] == "evaluated" and comparison["challenger_version"] == 2
    before = job.evaluate_alias("production").first()["accuracy"]
    job.promote()
    promoted = job.evaluate_alias("production").first()
    assert (promoted["version"] == 2) == comparison["should_promote"] and promoted["accuracy"] >= before
    job.rollback(1)
    assert job.evaluate_alias("production").first()["version"] == 1

    batch_id = job.score_batch(normalize_names(raw), ts=datetime(2024, 2, 3, 4, 5))
    stats = job.summarize_batch().first()
    assert stats["batch_id"] == batch_id and stats["total_predictions"] == 150 and stats["model_version"] == 1
    again = job.score_batch(smoke_rows(spark), ts=datetime(2024, 2, 4))
    assert space.read(history.PREDICTIONS).count() == 153 and job.summarize_batch(again).first()["total_predictions"] == 3
    drift = job.monitor(normalize_names(raw)).collect()
    assert {r["feature"] for r in drift} == set(SMOKE_FEATURES)
    assert not any(r["has_drift"] for r in drift)
    with pytest.raises(ValueError, match="missing"):
        job.score_batch(normalize_names(raw).drop("petal_width_cm"))
    with pytest.raises(ValueError, match="violated"):
        job.prepare(raw.selectExpr("*").withColumn("sepal length (cm)", -raw["sepal length (cm)"]), ["id"], rules=rules)


def test_production_keeps_its_scale_when_other_data_is_prepared(spark, raw):
    space = TableSpace(spark, f"t{uuid.uuid4().hex}").create()
    job = Lifecycle(space, "flowers", SMOKE_FEATURES)
    job.prepare(raw, ["id"])
    job.train(max_iter=5)
    job.promote(only_if_better=False, from_alias="baseline")
    rows = normalize_names(raw)

    def predictions(day):
        batch = job.score_batch(rows, ts=datetime(2024, 1, day))
        found = space.read(history.PREDICTIONS).filter(f"batch_id = '{batch}'").select(*SMOKE_FEATURES, "predicted_class", "prediction_probability")
        return sorted(map(tuple, found.collect()))

    before, accuracy = predictions(1), job.evaluate_alias("production").first()["accuracy"]
    shifted = raw.withColumns({c: raw[c] * 100 + 7 for c in raw.columns if c not in ("id", "target")})
    job.prepare(shifted, ["id"])
    assert predictions(2) == before and accuracy > 0.5
    second = job.train(max_iter=5)
    assert job.scaler(second.version) != job.scaler(1)


def test_monitoring_of_a_keyed_history(spark, raw):
    space = TableSpace(spark, f"t{uuid.uuid4().hex}").create()
    job = Lifecycle(space, "flowers", SMOKE_FEATURES, key=(("id", "BIGINT"),))
    job.prepare(raw, ["id"])
    job.train(max_iter=5)
    job.promote(only_if_better=False, from_alias="baseline")
    rows = normalize_names(raw)
    moved = rows.withColumn("petal_length_cm", rows["petal_length_cm"] * 4)
    for day, part in ((1, rows), (2, rows), (9, moved)):
        job.score_batch(part, ts=datetime(2024, 1, day, 5), batch_id=f"b{day}")
    job.score_batch(rows, ts=datetime(2024, 1, 9, 6), batch_id="b9")  # published already
    assert job.recent().count() == 450 and job.recent(1).count() == 150 and job.recent(8).count() == 300
    whole = {r["feature"]: r["has_drift"] for r in job.monitor(rows, days=30).collect()}
    last = {r["feature"]: r["has_drift"] for r in job.monitor(rows, days=1).collect()}
    assert last == {f: f == "petal_length_cm" for f in SMOKE_FEATURES} and not whole["sepal_width_cm"]
    changes = job.monitor_predictions(days=1, before=30).collect()
    assert any(r["has_drift"] for r in changes) and sum(r["change"] for r in changes if r["measure"] == "class share") == pytest.approx(0)

    job.record_labels(rows.filter("id < 60").withColumnRenamed("target", "label"), "l1", date(2024, 1, 3))
    job.record_labels(rows.withColumnRenamed("target", "label"), "l2", date(2024, 1, 10))
    found = {r["data_carga"].day: r for r in job.performance(horizon=5).collect()}
    assert {d: (r["n_predictions"], r["n_labelled"]) for d, r in found.items()} == {1: (150, 60), 2: (150, 60), 9: (150, 150)}
    assert found[1]["accuracy"] > 0.8 > found[9]["accuracy"] and found[9]["coverage"] == 1
    assert [r["data_carga"].day for r in job.performance(horizon=5, since=date(2024, 1, 2), until=date(2024, 1, 8)).collect()] == [2]

    due = job.retrain_due("b9", rows, days=1).first()
    assert due["features_moved"] and due["retrain"] and not job.retrain_due("b1", rows, days=None).first()["low_average"]
    with pytest.raises(ValueError, match="key"):
        Lifecycle(space, "flowers", SMOKE_FEATURES).performance()
    job.train(max_iter=1)
    before = job.compare().first()
    job.discard_loser()
    after = job.compare().first()["status"]
    assert before["status"] == "evaluated" and (after == "evaluated") == before["should_promote"]


@pytest.mark.parametrize("failing", ["model_scalers", "metrics_log", "model_coefficients", "model_signatures", "model_versions", "model_alias_log"])
def test_training_that_stops_leaves_a_clean_registry(spark, raw, failing, monkeypatch):
    space = TableSpace(spark, f"t{uuid.uuid4().hex}").create()
    job = Lifecycle(space, "flowers", SMOKE_FEATURES)
    job.prepare(raw, ["id"])
    append = TableSpace.append

    def stop(self, df, table, *more):
        if table == failing:
            raise RuntimeError("stopped")
        return append(self, df, table, *more)

    monkeypatch.setattr(TableSpace, "append", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        job.train(max_iter=2)
    monkeypatch.setattr(TableSpace, "append", append)
    model = job.train(max_iter=2)
    job.promote(only_if_better=False, from_alias="baseline")
    assert job.evaluate_alias("production").first()["version"] == model.version
    assert len(model.class_ids) == 3 == job.coefficients().filter(f"version = {model.version}").count()


def test_summary_falls_back_to_a_written_table(spark):
    small, large = Summary(spark.range(5), limit=5), Summary(spark.range(50), limit=5)
    assert small.small and not large.small
    assert small.rows.count() == 5 and large.rows.count() == 50
    assert "LocalTableScan" in small.rows._jdf.queryExecution().toString()
