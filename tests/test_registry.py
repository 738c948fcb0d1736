from datetime import datetime, timedelta

import numpy as np
import pytest

from tidemark.operators import registry

T0 = datetime(2024, 1, 1)


def make_log(spark, events):
    """Events (model, alias, op, version) in order, one minute apart."""
    rows = [(m, a, op, v, i + 1, T0 + timedelta(minutes=i)) for i, (m, a, op, v) in enumerate(events)]
    return spark.createDataFrame(rows, registry.ALIAS_LOG)


def state(log):
    return {(r["model_name"], r["alias"]): r["version"] for r in registry.current_aliases(log).collect()}


def request(spark, *rows):
    return spark.createDataFrame(list(rows), "model_name string, alias string, version int")


def test_latest_version_is_numeric(spark):
    versions = spark.createDataFrame([("m", "9"), ("m", "10"), ("k", "2")], "model_name string, version string")
    assert {tuple(r) for r in registry.latest_versions(versions).collect()} == {("m", 10), ("k", 2)}


def test_set_move_delete(spark):
    log = make_log(spark, [("m", "Production", "SET", 1)])
    assert registry.version_by_alias(log, "m", "production") == 1
    assert registry.version_by_alias(log, "m", "challenger") is None
    log = log.unionByName(registry.set_alias(log, request(spark, ("m", "production", 5))))
    assert state(log) == {("m", "production"): 5}
    drop = spark.createDataFrame([("m", "production")], "model_name string, alias string")
    log = log.unionByName(registry.delete_alias(log, drop))
    assert state(log) == {}
    assert registry.delete_alias(log, drop).isEmpty()
    assert [r["seq"] for r in log.orderBy("seq").collect()] == [1, 2, 3]


def test_model_by_missing_alias(spark):
    log = make_log(spark, [("m", "baseline", "SET", 1)])
    with pytest.raises(ValueError, match="no alias"):
        registry.model_by_alias(spark.createDataFrame([], "model_name string, version int"), log, "m", "production")


def test_register(spark):
    log = make_log(spark, [("a", "production", "SET", 3)])
    versions = spark.createDataFrame([("a", 3, T0)], registry.VERSIONS)
    models = spark.createDataFrame([("a",), ("new",)], "model_name string")
    rows, events = registry.register(versions, log, models)
    assert {(r["model_name"], r["version"]) for r in rows.collect()} == {("a", 4), ("new", 1)}
    assert {(r["model_name"], r["alias"], r["version"]) for r in events.collect()} == {
        ("a", "challenger", 4),
        ("new", "baseline", 1),
    }


@pytest.fixture
def contest(spark):
    log = make_log(
        spark,
        [
            ("win", "production", "SET", 5),
            ("win", "challenger", "SET", 6),
            ("tie", "production", "SET", 1),
            ("tie", "challenger", "SET", 2),
            ("alone", "production", "SET", 1),
            ("fresh", "challenger", "SET", 1),
        ],
    )
    rows = [("win", 5, 0.95), ("win", 6, 0.9734), ("tie", 1, 0.9), ("tie", 2, 0.9), ("alone", 1, 0.9), ("fresh", 1, 0.9)]
    accuracies = spark.createDataFrame(rows, "model_name string, version int, accuracy double")
    models = spark.createDataFrame([(m,) for m in ("win", "tie", "alone", "fresh", "none")], "model_name string")
    return log, registry.evaluate_ab(models, log, accuracies)


def test_comparison_promotion_and_discard(spark, contest):
    log, comparison = contest
    rows = {r["model_name"]: r for r in comparison.collect()}
    assert {m: r["status"] for m, r in rows.items()} == {
        "win": "evaluated",
        "tie": "evaluated",
        "alone": "no_challenger",
        "fresh": "no_production",
        "none": "no_production",
    }
    assert rows["win"]["winner"] == "challenger" and rows["win"]["should_promote"]
    assert rows["win"]["message"] == "challenger venceu com 0.0234 de melhoria em accuracy"
    assert rows["tie"]["winner"] == "production" and rows["tie"]["should_promote"] is False
    assert rows["alone"]["should_promote"] is None and rows["alone"]["production_version"] is None

    after = log.unionByName(registry.promote(log, comparison))
    assert state(after)["win", "production"] == 6 and ("win", "challenger") not in state(after)
    assert state(after)["tie", "production"] == 1
    assert registry.promote(after, comparison).isEmpty()

    after = log.unionByName(registry.discard_losers(log, comparison))
    assert ("tie", "challenger") not in state(after) and state(after)["win", "challenger"] == 6

    versions = spark.createDataFrame([("win", "4"), ("win", "5")], "model_name string, version string")
    targets = spark.createDataFrame([("win", 4), ("win", 99)], "model_name string, version int")
    after = log.unionByName(registry.rollback(log, targets, versions))
    assert state(after)["win", "production"] == 4


@pytest.mark.parametrize("broadcast_rows, spans_per_model", [(10**6, 10**6), (10**6, 10), (0, 100)])
def test_version_as_of_matches_brute_force(spark, broadcast_rows, spans_per_model):
    rng = np.random.default_rng(2)
    names = ["hot"] * 6 + ["b", "c"]
    log, preds = [], []
    for i in range(400):
        op = "DELETE" if rng.random() < 0.2 else "SET"
        at = T0 + timedelta(seconds=int(rng.integers(0, 5000)))
        log.append((str(rng.choice(names)), "production", op, None if op == "DELETE" else i, i, at))
    for i in range(600):
        at = T0 + timedelta(seconds=int(rng.integers(-50, 5200))) if i % 3 else T0 + timedelta(seconds=2500)
        preds.append((i, str(rng.choice(names + ["unknown"])), at))
    expected = {}
    for i, model, at in preds:
        earlier = [e for e in log if e[0] == model and e[5] <= at]
        last = max(earlier, key=lambda e: (e[5], e[4]), default=None)
        expected[i] = last[3] if last else None
    found = registry.production_version_asof(
        spark.createDataFrame(preds, "id int, model_name string, at timestamp").repartition(4),
        spark.createDataFrame(log, registry.ALIAS_LOG),
        "at",
        broadcast_rows=broadcast_rows,
        spans_per_model=spans_per_model,
    )
    rows = found.collect()
    assert len(rows) == len(preds) and {r["id"]: r["version_asof"] for r in rows} == expected


def test_intervals(spark):
    log = make_log(spark, [("m", "production", "SET", 1), ("m", "production", "SET", 2), ("m", "production", "DELETE", None)])
    rows = [tuple(r) for r in registry.alias_intervals(log).orderBy("valid_from").collect()]
    assert rows == [("m", 1, T0, T0 + timedelta(minutes=1)), ("m", 2, T0 + timedelta(minutes=1), T0 + timedelta(minutes=2))]


def test_metric_rows(spark):
    rows = registry.metric_rows(spark.createDataFrame([("accuracy", 0.5)], "metric string, value double"), "r", "m", 2)
    assert [tuple(r) for r in rows.collect()] == [("r", "m", 2, "accuracy", 0.5)]


def test_param_rows(spark):
    rows = registry.param_rows(spark, {"solver": "lbfgs", "depth": None, "c": 0.5}, "r", "m", 2)
    assert [tuple(r) for r in rows.collect()] == [("r", "m", 2, "c", "0.5"), ("r", "m", 2, "depth", None), ("r", "m", 2, "solver", "lbfgs")]
