"""Sketch tables and what they roll up to, against numpy."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.sketches import QUARTILES, rank_bound, rank_errors, read_profile, roll_up, sketch_table

START = date(2024, 1, 1)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(0)
    out = []
    for d in range(20):
        n = 6000 if d == 7 else 300  # one day with a third of the rows and more
        for k, v in zip(rng.choice(["a", "b"], n), 1e6 + rng.gamma(2.0, 3.0, n)):
            out.append((START + timedelta(days=d), str(k), float(v), None if d % 3 else float("nan")))
    out += [(START, "empty", None, None), (None, "a", 1e6, 1.0)]
    return out


@pytest.fixture(scope="module")
def rows(spark, values):
    return spark.createDataFrame(values, "ts date, kind string, v double, w double").repartition(6).cache()


def exact(values, keep):
    v = np.array([x[2] for x in values if x[2] is not None and keep(x)])
    return v


def test_roll_up_equals_moments_of_the_rows(spark, rows, values):
    table = sketch_table(rows, "ts", ["v", "w"], ["kind"])
    weeks = roll_up(table, {"week": F.date_trunc("week", "day"), "kind": F.col("kind")})
    months = roll_up(weeks, ["kind"])  # rolled up twice
    found = {(r["kind"], r["feature"]): r for r in read_profile(months, ["kind"]).collect()}
    for kind in ("a", "b"):
        v, r = exact(values, lambda x: x[1] == kind), found[kind, "v"]
        assert r["count"] == len(v) and r["min"] == v.min() and r["max"] == v.max()
        assert r["mean"] == pytest.approx(v.mean(), rel=1e-12) and r["std"] == pytest.approx(v.std(ddof=1), rel=1e-3)
        for name, p in QUARTILES.items():
            ranks = (v < r[name]).mean(), (v <= r[name]).mean()
            assert max(ranks[0] - p, p - ranks[1], 0) <= 2 * rank_bound()
    none = found["empty", "v"]
    assert none["count"] == 0 and none["p50"] is None and none["mean"] is None and none["std"] is None
    assert found["b", "w"]["count"] == 0 and found["a", "w"]["count"] == 1 and found["a", "w"]["std"] is None


def test_small_groups_are_exact(spark, rows, values):
    table = sketch_table(rows.filter("ts <> DATE '2024-01-08'"), "ts", ["v"], ["kind"])
    found = read_profile(table, ["day", "kind"])
    assert rank_errors(rows, found.filter("kind <> 'empty'"), "v", {"day": F.col("ts"), "kind": F.col("kind")}).agg(F.max("rank_error")).first()[0] <= 1 / 100


def test_rank_errors_by_brute_force(spark, rows, values):
    table = roll_up(sketch_table(rows, "ts", ["v"], ["kind"], size=16), ["kind"])
    profile = read_profile(table, ["kind"]).cache()
    marks = {r["kind"]: r for r in profile.collect()}
    found = {(r["kind"], r["quantile"]): r for r in rank_errors(rows, profile, "v", {"kind": F.col("kind")}).collect()}
    assert set(found) == {(k, q) for k in "ab" for q in QUARTILES}
    for (kind, q), r in found.items():
        v = exact(values, lambda x: x[1] == kind)
        mark, p = marks[kind][q], QUARTILES[q]
        expected = max((v < mark).mean() - p, p - (v <= mark).mean(), 0)
        assert r["rank_error"] == pytest.approx(expected, abs=1e-12) and r["count"] == len(v)


def test_rolling_up_reads_no_rows(spark, rows, tmp_path):
    sketch_table(rows, "ts", ["v"], ["kind"]).write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    plan = roll_up(stored, ["kind"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "total:double" in plan


def test_larger_sketches_have_smaller_bounds():
    assert rank_bound(200) == pytest.approx(0.0193, abs=2e-4) and rank_bound(800) < rank_bound(400) < 0.011
