import pytest
from pyspark.sql import functions as F

from tidemark.operators import prep
from tidemark.operators.scaling import apply_scaler, fit_scaler

RAW = "`sepal length (cm)` double, `sepal width (cm)` double, `petal length (cm)` double, `petal width (cm)` double, target int"
ROWS = [(5.1, 3.5, 1.4, 0.2, 0), (4.9, 3.0, 1.4, 0.2, 0), (4.7, 3.2, 1.3, 0.2, 0)]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, RAW)


def test_names_and_ratios(raw):
    df = prep.normalize_names(raw)
    assert df.columns == ["sepal_length_cm", "sepal_width_cm", "petal_length_cm", "petal_width_cm", "target"]
    rows = prep.ratio_area(df).collect()
    for row, (a, b, c, d, _) in zip(rows, ROWS):
        assert row["sepal_ratio"] == pytest.approx(a / b, abs=1e-9)
        assert row["sepal_area"] == pytest.approx(a * b, abs=1e-9)
        assert row["petal_ratio"] == pytest.approx(c / d, abs=1e-9)


def test_name_collision(spark):
    with pytest.raises(ValueError, match="collide"):
        prep.normalize_names(spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int"))


def test_schema_and_rows(spark, raw):
    with pytest.raises(ValueError, match="petal_x"):
        prep.check_schema(raw, ["target", "petal_x"])
    with pytest.raises(ValueError, match="empty"):
        prep.require_rows(raw.limit(0))
    assert prep.numeric_columns(spark.createDataFrame([(1, "a", 2.0)], "x int, s string, y double")) == ["x", "y"]
    x, y = prep.split_features_label(raw, "target")
    assert "target" not in x.columns and y.columns == ["target"]


def test_quality_rules(spark):
    df = spark.createDataFrame([(1.0, "3"), (-1.0, "x"), (None, "4")], "length double, code string")
    rules = {**prep.null_rules(["length"]), **prep.range_rules({"length": (0, None)}), **prep.type_rules(df, {"code": "int"})}
    found = {r["rule"]: r["violations"] for r in prep.dq_report(df, rules).collect()}
    assert found == {"length_null": 1, "length_range": 1, "code_type": 1}
    with pytest.raises(ValueError, match="length_range"):
        prep.dq_report(df, rules, strict=True)
    valid, rejected = prep.dq_split(df, rules)
    assert [r["length"] for r in valid.collect()] == [1.0]
    assert sorted(r["broken_rules"] for r in rejected.collect()) == [["length_null"], ["length_range", "code_type"]]


def test_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("d",), ("c",), (None,)], "kind string")
    ids = {r["kind"]: r["class_id"] for r in prep.dense_class_ids(df, "kind").collect()}
    assert ids == {"a": 0, "b": 1, "c": 2, "d": 3, None: None}
    named = prep.map_labels(spark.createDataFrame([(0,), (7,)], "c int"), "c", {0: "Setosa"})
    assert [r["class_name"] for r in named.collect()] == ["Setosa", "Classe 7"]
    bare = prep.map_labels(spark.createDataFrame([(7,)], "c int"), "c", {0: "Setosa"}, fallback=None)
    assert bare.first()["class_name"] is None


def test_signature(spark, raw):
    df = prep.normalize_names(raw)
    contract = prep.model_signature(df, ["sepal_length_cm"])
    assert prep.check_signature(df, contract) is df
    with pytest.raises(ValueError, match="signature"):
        prep.check_signature(df.withColumn("sepal_length_cm", F.lit("x")), contract)


def test_date_range_is_inclusive_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(1, 29).selectExpr("make_date(2024, 1, cast(id AS int)) AS day", "id AS d").write.parquet(path)
    rows = prep.date_range(spark.read.parquet(path), "day", "2024-01-05", "2024-01-07")
    assert sorted(r["d"] for r in rows.collect()) == [5, 6, 7]
    plan = rows._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(day,2024-01-05)" in plan


def test_gate(spark):
    metrics = spark.createDataFrame([("accuracy", 0.89), ("recall", 0.9)], "metric string, value double")
    row = prep.metric_gate(metrics, {"accuracy": 0.9}).collect()
    assert len(row) == 1 and row[0]["passed"] is False


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (float("nan"), 5.0), (None, 5.0), (3.0, 5.0)], "x double, c double")
    params = fit_scaler(df, ["x", "c"])
    values = {r["feature"]: r for r in params.collect()}
    assert values["x"]["mean"] == 2.0 and values["x"]["scale"] == pytest.approx((2 / 3) ** 0.5)
    assert values["c"]["scale"] == 1.0
    scaled = apply_scaler(df, params, ["x", "c"])
    assert [r["c"] for r in scaled.collect()] == [0.0] * 5
    assert [r["x"] is None for r in scaled.collect()] == [False, False, True, True, False]
    facts = scaled.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    assert facts["m"] == pytest.approx(0, abs=1e-12) and facts["s"] == pytest.approx(1)
    with pytest.raises(ValueError, match="no parameters"):
        apply_scaler(df, {"x": (0.0, 1.0)}, ["c"])
