"""Registration, shared inputs and the SQL fragments that mirror them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import rounded
from tidemark.operators.scaling import fit_scaler
from tidemark.operators.scoring import LinearModel, score
from tidemark.sources.tables import load_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name``, with the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: rounded(c, digits) for c in doubles})


def rnd(expression: str, digits: int = 6) -> str:
    """The SQL twin of ``rounded``."""
    return f"floor(({expression}) * 1e{digits} + 0.5e0) / 1e{digits}"


FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CLASS_IDS = (0, 1, 2)
CLASS_NAMES = {0: "Setosa", 1: "Versicolor", 2: "Virginica"}
CUT = "1998-01-01"

MODEL = LinearModel(
    name="returns",
    version=3,
    features=FEATURES,
    class_ids=CLASS_IDS,
    intercepts=(0.1, -0.2, 0.05),
    weights=((0.9, -0.4, 0.7, -0.3), (-0.5, 0.8, -0.6, 0.2), (0.15, -0.35, 0.45, 1.1)),
)
RIVAL = LinearModel(
    name="returns",
    version=4,
    features=FEATURES,
    class_ids=CLASS_IDS,
    intercepts=(0.0, 0.1, -0.1),
    weights=((-0.2, 0.6, 0.1, 0.4), (0.7, -0.9, 0.3, -0.2), (0.25, 0.35, -0.55, 0.6)),
)


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return load_parquet(spark, folder, "lineitem")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the return flag as class 0/1/2."""
    flag = F.col("l_returnflag")
    target = F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2)
    return lineitem(spark, folder).withColumn("target", target)


def scored(spark: SparkSession, folder: str, model: LinearModel = MODEL) -> DataFrame:
    """Labelled line items scored by a fixed model; the scaler is fitted on the same table."""
    rows = labelled(spark, folder)
    return score(rows, model, fit_scaler(rows, FEATURES))


def month(name: str) -> F.Column:
    return F.date_format(name, "yyyy-MM")


TARGET_SQL = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


def scored_ctes(model: LinearModel = MODEL, name: str = "scored", source: str = "lineitem") -> str:
    """CTEs ending in ``name``: the SQL twin of ``scored``."""
    params = ", ".join(
        f"avg({f}) AS m{i}, CASE WHEN stddev_pop({f}) = 0 THEN 1.0e0 ELSE stddev_pop({f}) END AS s{i}"
        for i, f in enumerate(FEATURES)
    )
    xs = ", ".join(f"({f} - m{i}) / s{i} AS x{i}" for i, f in enumerate(FEATURES))
    zs = ", ".join(
        f"{b!r}e0 + " + " + ".join(f"({w!r}e0) * x{j}" for j, w in enumerate(ws)) + f" AS z{i}"
        for i, (b, ws) in enumerate(zip(model.intercepts, model.weights))
    )
    ps = ", ".join(f"e{i} / (e0 + e1 + e2) AS probability_class_{i}" for i in range(3))
    return f"""{name}_p AS (SELECT {params} FROM {source}),
{name}_x AS (SELECT *, {TARGET_SQL} AS target, {xs} FROM {source} CROSS JOIN {name}_p),
{name}_z AS (SELECT *, {zs} FROM {name}_x),
{name}_e AS (SELECT *, exp(z0 - greatest(z0, z1, z2)) AS e0, exp(z1 - greatest(z0, z1, z2)) AS e1,
  exp(z2 - greatest(z0, z1, z2)) AS e2 FROM {name}_z),
{name} AS (SELECT *, {ps},
  CASE WHEN z0 >= z1 AND z0 >= z2 THEN 0 WHEN z1 >= z2 THEN 1 ELSE 2 END AS predicted_class,
  greatest(e0, e1, e2) / (e0 + e1 + e2) AS prediction_probability, {model.version} AS model_version FROM {name}_e)"""


def long_sql(features: tuple[str, ...], extra: str = "", source: str = "lineitem") -> str:
    """UNION ALL of (extra, feature, v) over the features."""
    lead = f"{extra}, " if extra else ""
    return " UNION ALL ".join(f"SELECT {lead}'{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {source}" for f in features)
