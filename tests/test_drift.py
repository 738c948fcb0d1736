import itertools
import math

import numpy as np
import pytest

from tidemark.functions.exact_ks import exact_two_sided
from tidemark.operators import drift
from tidemark.sources.workspace import literal_frame

RNG = np.random.default_rng(3)


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)


def brute(a, b):
    a, b = np.sort(np.asarray(a, float)), np.sort(np.asarray(b, float))
    points = np.union1d(a, b)
    return np.abs(
        np.searchsorted(a, points, "right") / len(a) - np.searchsorted(b, points, "right") / len(b)
    ).max()


def run(spark, a, b, **options):
    return drift.ks_two_sample(frame(spark, a), frame(spark, b), ["x"], **options).first()


@pytest.mark.parametrize(
    "a, b, distance",
    [
        (range(1, 11), range(1, 11), 0.0),
        (range(1, 11), range(101, 111), 1.0),
        ([1, 1, 2], [1, 2, 2], 1 / 3),
        ([0.0, -0.0, 1], [0.0, 0.0, 1], 0.0),
    ],
)
def test_known_distances(spark, a, b, distance):
    row = run(spark, a, b, method="auto")
    assert row["drift_score"] == pytest.approx(distance)
    assert row["has_drift"] == (distance == 1.0)


@pytest.mark.parametrize(
    "a, b",
    [
        (RNG.normal(size=900), RNG.normal(0.1, 1, 1300)),
        (np.exp(5 * RNG.normal(size=800)), np.exp(5 * RNG.normal(size=800))),
        (np.r_[np.full(700, 1.5), RNG.normal(size=700)], np.r_[np.full(300, 1.5), RNG.normal(size=1100)]),
        (RNG.normal(size=1500), RNG.normal(3, 1, 1500)),
    ],
)
def test_distance_equals_brute_force_and_is_symmetric(spark, a, b):
    one = run(spark, a, b, method="asymp")["drift_score"]
    other = run(spark, b, a, method="asymp")["drift_score"]
    assert one == pytest.approx(brute(a, b), abs=1e-12) and one == pytest.approx(other, abs=1e-12)


@pytest.mark.parametrize("n, m", [(3, 3), (4, 3), (5, 4), (2, 6)])
def test_exact_probability_by_enumeration(n, m):
    pool = range(n + m)
    distances = [brute([x for x in pool if x in chosen], [x for x in pool if x not in chosen]) for chosen in map(set, itertools.combinations(pool, n))]
    for d in sorted(set(np.round(distances, 12))):
        share = np.mean([x >= d - 1e-9 for x in distances])
        assert exact_two_sided(float(d), n, m) == pytest.approx(share, abs=1e-12)


def test_large_sample_probability_is_close_to_exact(spark):
    rows = literal_frame(spark, {"d": [0.02, 0.03, 0.045], "n": [4000] * 3, "m": [5003] * 3})
    p = rows.select("d", drift.ks_tail_probability(rows.d, rows.n, rows.m).alias("p")).collect()
    for row in p:
        assert row["p"] == pytest.approx(exact_two_sided(row["d"], 4000, 5003), abs=0.01)


def test_auto_uses_exact_for_small_samples(spark):
    a, b = RNG.normal(size=40), RNG.normal(0.8, 1, 55)
    row = run(spark, a, b, method="auto")
    assert row["p_value"] == pytest.approx(exact_two_sided(brute(a, b), 40, 55), rel=1e-9)
    assert run(spark, a, b, method="exact")["p_value"] == row["p_value"]


def test_missing_values(spark):
    a, b = [1, 2, None, float("nan"), 3], [1, 2, 3]
    assert run(spark, a, b)["drift_score"] == pytest.approx(0.0)
    row = run(spark, a, b, null_policy="propagate")
    assert row["drift_score"] is None and row["p_value"] is None and row["has_drift"] is False
    empty = run(spark, [None, None], b)
    assert (empty["n_base"], empty["n_prod"]) == (0, 3)
    assert empty["drift_score"] is None and empty["p_value"] is None and empty["has_drift"] is False
    with pytest.raises(ValueError, match="method"):
        run(spark, a, b, method="guess")


def test_exact_beyond_its_reach_is_an_error_and_never_no_drift(spark):
    a, b = spark.range(10_001).selectExpr("double(id) x"), spark.range(10_001).selectExpr("double(id + 20000) x")
    with pytest.raises(ValueError, match="exact"):
        drift.ks_two_sample(a, b, ["x"], method="exact")
    assert drift.ks_two_sample(a, b, ["x"]).first()["has_drift"]


def test_report(spark):
    schema = "a double, b double, z double"
    base = spark.createDataFrame([(float(i), float(i), 0.0) for i in range(200)], schema)
    prod = spark.createDataFrame([(float(i), i * 2.0, 1.0) for i in range(200)], schema)
    details = {r["feature"]: r for r in drift.drift_details(base, prod, ["a", "b", "z"]).collect()}
    assert details["z"]["diff_pct"] is None and details["b"]["diff_pct"] == pytest.approx(100.0)
    row = drift.drift_report(base, prod, ["a", "b", "z"]).first()
    assert row["any_drift"] and row["drifted_features"] == ["b", "z"] and row["recommendation"] == drift.RETRAIN
    calm = drift.drift_report(base, base, ["a"]).first()
    assert not calm["any_drift"] and calm["drifted_features"] == [] and calm["recommendation"] == drift.STABLE
    assert drift.any_drift(drift.ks_two_sample(base, prod, ["a", "b"])).first()["any_drift"]


def test_class_share(spark):
    a = spark.createDataFrame([(0,), (0,), (1,), (None,)], "predicted_class int")
    b = spark.createDataFrame([(1,), (2,)], "predicted_class int")
    rows = {r["class"]: (r["baseline_share"], r["recent_share"]) for r in drift.class_share_drift(a, b).collect()}
    assert rows[0] == (pytest.approx(2 / 3), 0.0) and rows[2] == (0.0, 0.5)
    assert math.isclose(sum(x for x, _ in rows.values()), 1.0)
