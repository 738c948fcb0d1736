"""Named tables and parquet files as lazy frames, and the sinks for intermediate tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.prep import check_schema, require_rows, split_features_label


@dataclass(frozen=True)
class TableSpace:
    """A schema (optionally inside a catalog) that holds the tables of one environment."""

    spark: SparkSession
    schema: str = "default"
    catalog: str | None = None
    format: str = "parquet"

    def name(self, table: str) -> str:
        return ".".join(f"`{part}`" for part in (self.catalog, self.schema, table) if part)

    def create(self) -> TableSpace:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {'.'.join(p for p in (self.catalog, self.schema) if p)}")
        return self

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        """Full scan, lazy: later projections and filters still reach the files."""
        return self.spark.table(self.name(table))

    def read_or_empty(self, table: str, schema: str) -> DataFrame:
        return self.read(table) if self.exists(table) else self.spark.createDataFrame([], schema)

    def overwrite(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        writer = df.write.format(self.format).mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.name(table))
        return self.read(table)

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        writer = df.write.format(self.format).mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.name(table))

    def tables(self) -> DataFrame:
        """Names of the tables in the schema."""
        return self.spark.sql(f"SHOW TABLES IN {'.'.join(p for p in (self.catalog, self.schema) if p)}")


def load_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def load_train_test(
    space: TableSpace, label: str = "target", train: str = "train", test: str = "test"
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Feature and label frames of both tables: ``x_train, x_test, y_train, y_test``.

    The label frames are projections of the same scan; to pair features with labels row by row,
    keep them in one frame.
    """
    x_train, y_train = split_features_label(space.read(train), label)
    x_test, y_test = split_features_label(space.read(test), label)
    return x_train, x_test, y_train, y_test


def save_train_test(
    space: TableSpace, train: DataFrame, test: DataFrame, train_name: str = "train", test_name: str = "test"
) -> None:
    space.overwrite(train, train_name)
    space.overwrite(test, test_name)


def load_inference(space: TableSpace, features: Sequence[str], table: str = "dataset_drift") -> DataFrame:
    """The required features of a non-empty table."""
    df = require_rows(space.read(table), space.name(table))
    return check_schema(df, features).select(*features)


def stage_new_data(
    space: TableSpace, features: Sequence[str], source: str = "dataset_drift", target: str = "batch_inference_staging"
) -> DataFrame:
    """Validated copy of the source with all its columns."""
    df = require_rows(check_schema(space.read(source), features), space.name(source))
    return space.overwrite(df, target)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of hand-written rows, for smoke checks and seeds."""
    return spark.createDataFrame(list(rows), schema)


# fixed values: three measurements for a scoring smoke check
SMOKE_FEATURES = ("sepal_length_cm", "sepal_width_cm", "petal_length_cm", "petal_width_cm")
SMOKE_ROWS = ((5.1, 3.5, 1.4, 0.2), (6.7, 3.0, 5.2, 2.3), (4.9, 2.5, 4.5, 1.7))


def smoke_rows(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, SMOKE_ROWS, ", ".join(f"{f} double" for f in SMOKE_FEATURES))
