import math

import numpy as np
import pytest

from tidemark.operators import profile
from tidemark.operators.ordering import cell_grid, exact_quantiles, to_cells

RNG = np.random.default_rng(7)


def frame(spark, values, group=None):
    group = ["g"] * len(values) if group is None else group
    rows = [(None if v is None else float(v), g) for v, g in zip(values, group)]
    return spark.createDataFrame(rows, "x double, g string").repartition(5)


SHAPES = {
    "normal": RNG.normal(size=3000),
    "heavy_tail": np.exp(RNG.normal(size=3000) * 6),
    "hot_value": np.concatenate([np.full(1000, 2.5), RNG.uniform(0, 5, 2000)]),
    "few_values": RNG.integers(0, 4, 2000).astype(float),
    "constant": np.full(50, 3.0),
    "signed_zero": np.concatenate([np.full(500, -0.0), np.full(500, 0.0), RNG.normal(size=500)]),
    "huge": np.array([-1.7e308, 1.7e308, 0.0, 1.0, 2.0]),
    "single": np.array([4.0]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_from_cells_are_exact(spark, shape):
    values = SHAPES[shape]
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    rows = exact_quantiles(frame(spark, values), ["x"], wanted).collect()
    got = {r["probability"]: r["value"] for r in rows}
    ordered = np.sort(values)
    for p in wanted:
        at = p * (len(values) - 1)
        low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
        share = at - math.floor(at)
        assert got[p] == pytest.approx((1 - share) * low + share * high, rel=1e-12)


def test_cells_follow_the_order_of_values(spark):
    df = frame(spark, [float("-inf"), *SHAPES["heavy_tail"], float("inf"), None, float("nan")])
    rows = to_cells(df, cell_grid(df, ["x"])).orderBy("value").collect()
    assert len(rows) == 3002
    cells = [r["cell"] for r in rows]
    assert cells == sorted(cells) and len(set(cells)) > 1000


def test_describe_matches_numpy(spark):
    values = list(RNG.normal(10, 3, 1200)) + [None, float("nan")]
    group = ["a" if i % 3 else None for i in range(len(values))]
    df = frame(spark, values, group)
    for row in profile.describe_numeric(df, ["x"], ["g"]).collect():
        mine = np.array([v for v, g in zip(values, group) if g == row["g"] and v is not None and not math.isnan(v)])
        assert row["count"] == len(mine)
        assert row["std"] == pytest.approx(mine.std(ddof=1))
        for q, name in ((25, "p25"), (50, "p50"), (75, "p75")):
            assert row[name] == pytest.approx(np.percentile(mine, q))


def test_approximate_profile(spark):
    row = profile.distribution_stats(frame(spark, range(1001)), ["x"], accuracy=10_000).first()
    assert row["median"] == pytest.approx(500, abs=2) and row["max"] == 1000.0


def test_counts(spark):
    df = frame(spark, [1, 1, 2, None, 3, 3])
    rows = [(r["x"], r["count"], r["pct"]) for r in profile.value_counts(df, "x", pct=True).collect()]
    assert rows == [(1.0, 2, 40.0), (3.0, 2, 40.0), (2.0, 1, 20.0)]
    info = {r["column"]: (r["dtype"], r["non_null"], r["rows"]) for r in profile.non_null_info(df).collect()}
    assert info == {"x": ("double", 5, 6), "g": ("string", 6, 6)}


def test_confidence_views(spark):
    df = spark.createDataFrame([(0.7,), (0.69,), (1.0,), (0.0,), (None,)], "prediction_probability double")
    assert [r[0] for r in profile.low_confidence(df).collect()] == [0.69, 0.0]
    bins = {r["bin"]: r["count"] for r in profile.confidence_histogram(df).collect()}
    assert bins == {0: 1, 6: 1, 7: 1, 9: 1}
    rate = profile.low_confidence_rate(df, []).first()
    assert (rate["low_confidence_count"], rate["total"], rate["low_confidence_pct"]) == (2, 5, 40.0)


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, None), (1.0, "a")], "x double, s string")
    assert {r["column"]: r["non_null"] for r in profile.non_null_info(df).collect()} == {"x": 2, "s": 3}
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [(1.0, 2)]
