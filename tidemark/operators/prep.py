"""Projection, filtering and validation of incoming tables."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import class_name, ratio
from tidemark.sources.workspace import Summary, durable

# what a name loses or changes: blanks join words, brackets go
_NAME = str.maketrans(" ", "_", "()")

# fixed values: the measurements that belong together
DEFAULT_PAIRS = {
    "sepal": ("sepal_length_cm", "sepal_width_cm"),
    "petal": ("petal_length_cm", "petal_width_cm"),
}


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names with spaces as underscores and without parentheses."""
    names = [name.translate(_NAME) for name in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalisation: {names}")
    return df.toDF(*names)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in source order, from the schema alone."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def split_features_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Everything but the label, and the label alone."""
    check_schema(df, [label])
    return df.drop(label), df.select(label)


def select_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    check_schema(df, features)
    return df.select(*features)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in set(df.columns)]


def check_schema(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``df`` itself, or ValueError naming the missing columns. Runs no job."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"required columns missing: {missing}; the table must have {list(required)}")
    return df


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """``df`` itself, or ValueError when it has no row. Reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def map_labels(
    df: DataFrame, column: str, names: Mapping[int, str], target: str = "class_name", fallback: str | None = "Classe "
) -> DataFrame:
    """Adds the class name of an id column."""
    return df.withColumn(target, class_name(column, dict(names), fallback))


def class_dictionary(df: DataFrame, column: str, target: str = "class_id") -> DataFrame:
    """Rows (column, ``target``) with ids 0,1,2,... in the sorted order of the distinct labels.

    Labels are sorted by ranges, numbered inside each and moved on by the sizes of the ranges before it: however many
    there are, no task or row holds them all.
    """
    found = df.filter(F.col(column).isNotNull()).select(column).distinct()
    ranged = durable(found.repartitionByRange(column).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    # one row per range
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    numbered = ranged.withColumn("_place", place).join(starts, "_range")
    return numbered.select(column, (F.col("_start") + F.col("_place")).cast("int").alias(target))


def dense_class_ids(df: DataFrame, column: str, target: str = "class_id") -> DataFrame:
    """Adds ids 0,1,2,... following the sorted order of the distinct labels; NULL labels keep NULL."""
    dictionary = Summary(class_dictionary(df, column, "_id").withColumnRenamed(column, "_label")).joinable()
    joined = df.drop(target).join(dictionary, F.col(column) == F.col("_label"), "left")
    return joined.withColumn(target, F.col("_id")).drop("_id", "_label")


def ratio_area(df: DataFrame, pairs: Mapping[str, tuple[str, str]] = DEFAULT_PAIRS) -> DataFrame:
    """Adds ``{name}_ratio`` (a/b) and ``{name}_area`` (a*b) for each named column pair."""
    check_schema(df, [c for pair in pairs.values() for c in pair])
    derived: dict[str, Column] = {}
    for name, (a, b) in pairs.items():
        derived[f"{name}_ratio"] = ratio(a, b)
        derived[f"{name}_area"] = F.col(a).cast("double") * F.col(b).cast("double")
    return df.withColumns(derived)


def date_range(df: DataFrame, ts: str, start: date | datetime | str, end: date | datetime | str) -> DataFrame:
    """Rows with ``start <= ts <= end``; plain comparisons, so they reach the parquet scan.

    An end without a time of day includes that whole day.
    """
    kind = df.schema[ts].dataType
    after, last = F.col(ts) >= F.lit(start).cast(kind), F.lit(end).cast(kind)
    whole_day = re.fullmatch(r"\d{4}-\d{2}-\d{2}", end.strip()) if isinstance(end, str) else not isinstance(end, datetime)
    if whole_day and not isinstance(kind, T.DateType):
        return df.filter(after & (F.col(ts) < F.date_add(F.lit(end).cast("date"), 1).cast(kind)))
    return df.filter(after & (F.col(ts) <= last))


def null_rules(columns: Sequence[str]) -> dict[str, tuple[str, Column]]:
    """Violated by NULL, and by NaN in floating-point columns."""
    nan = lambda c: F.typeof(c).isin("double", "float") & (F.col(c).cast("string") == "NaN")
    return {f"{c}_null": (c, F.col(c).isNull() | nan(c)) for c in columns}


def range_rules(bounds: Mapping[str, tuple[float | None, float | None]]) -> dict[str, tuple[str, Column]]:
    """Violated when a value lies outside ``[low, high]``; either bound may be None."""
    rules = {}
    for c, (low, high) in bounds.items():
        broken = F.lit(False)
        if low is not None:
            broken = broken | (F.col(c) < low)
        if high is not None:
            broken = broken | (F.col(c) > high)
        rules[f"{c}_range"] = (c, broken)
    return rules


def type_rules(df: DataFrame, types: Mapping[str, str]) -> dict[str, tuple[str, Column]]:
    """Violated by values that do not convert to the wanted type."""
    return {f"{c}_type": (c, F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull()) for c, t in types.items()}


def dq_report(df: DataFrame, rules: Mapping[str, tuple[str, Column]], strict: bool = False) -> DataFrame:
    """One scan for all rules: rows ``(rule, column, violations, total_rows)``.

    ``strict`` raises ValueError when any rule is broken.
    """
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.coalesce(broken, F.lit(False))).alias(f"_r{i}") for i, (_, broken) in enumerate(rules.values())],
    )
    report = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(rule).alias("rule"),
                        F.lit(column).alias("column"),
                        F.col(f"_r{i}").alias("violations"),
                        F.col("_rows").alias("total_rows"),
                    )
                    for i, (rule, (column, _)) in enumerate(rules.items())
                ]
            )
        )
    )
    if strict:
        broken = [(r["rule"], r["violations"]) for r in report.filter("violations > 0").collect()]
        if broken:
            raise ValueError(f"data quality rules violated: {broken}")
    return report


def dq_split(df: DataFrame, rules: Mapping[str, tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the list of rules each one broke."""
    broken = F.filter(
        F.array(*[F.when(condition, F.lit(rule)) for rule, (_, condition) in rules.items()]), lambda x: x.isNotNull()
    )
    marked = df.withColumn("broken_rules", broken)
    return marked.filter(F.size("broken_rules") == 0).drop("broken_rules"), marked.filter(F.size("broken_rules") > 0)


def model_signature(df: DataFrame, features: Sequence[str]) -> str:
    """The input contract of a model: names and types of its features, as schema JSON."""
    return df.select(*features).schema.json()


def check_signature(df: DataFrame, signature: str) -> DataFrame:
    """``df`` itself, or ValueError when a column of the contract is missing or has another type."""
    wanted = T.StructType.fromJson(json.loads(signature))
    check_schema(df, wanted.names)
    wrong = [
        f"{f.name}: {df.schema[f.name].dataType.simpleString()} instead of {f.dataType.simpleString()}"
        for f in wanted.fields
        if df.schema[f.name].dataType != f.dataType
    ]
    if wrong:
        raise ValueError(f"columns do not match the model signature: {wrong}")
    return df


def metric_gate(metrics: DataFrame, minimum: Mapping[str, float]) -> DataFrame:
    """Long metric rows ``(..., metric, value)`` named in ``minimum``, with ``required`` and ``passed``."""
    required = F.create_map(*[F.lit(x) for item in minimum.items() for x in item])
    return (
        metrics.filter(F.col("metric").isin(list(minimum)))
        .withColumn("required", F.try_element_at(required, F.col("metric")))
        .withColumn("passed", F.coalesce(F.col("value") >= F.col("required"), F.lit(False)))
    )
