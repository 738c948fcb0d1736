"""The date-partitioned prediction history and the tables kept next to it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.ledger import Ledger
from tidemark.sources.tables import TableSpace

PREDICTIONS = "batch_predictions"
POINTER = "batch_inference_metadata_temp"
METADATA = "batch_inference_metadata"
PARTITION = "data_carga"


def prediction_columns(features: Sequence[str], class_ids: Sequence[int]) -> list[tuple[str, str, str]]:
    """Name, type and comment of every column, in table order."""
    return [
        ("batch_id", "STRING", "Unique id of the batch"),
        ("prediction_timestamp", "TIMESTAMP", "When the prediction was made"),
        (PARTITION, "DATE", "Processing date"),
        ("model_version", "INT", "Version of the model"),
        ("model_alias", "STRING", "Alias the model was loaded by"),
        *[(f, "DOUBLE", f"{f} (original scale)") for f in features],
        ("predicted_class", "INT", "Predicted class"),
        ("prediction_probability", "DOUBLE", "Confidence of the prediction"),
        *[(f"probability_class_{c}", "DOUBLE", f"Probability of class {c}") for c in class_ids],
    ]


def create_predictions_table(
    space: TableSpace, features: Sequence[str], class_ids: Sequence[int], table: str = PREDICTIONS
) -> None:
    """Creates the history table if it is not there, partitioned by load date."""
    columns = ", ".join(f"`{n}` {t} COMMENT '{c}'" for n, t, c in prediction_columns(features, class_ids))
    space.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {space.name(table)} ({columns}) USING {space.format} "
        f"PARTITIONED BY ({PARTITION}) COMMENT 'Batch predictions'"
    )


def predictions_ledger(
    space: TableSpace,
    features: Sequence[str],
    class_ids: Sequence[int],
    key: Sequence[tuple[str, str]] = (),
    table: str = PREDICTIONS,
) -> Ledger:
    """The history as a ledger of whole batches, with the row key (name, type) that later labels are joined by."""
    columns = [*key, *[(n, t) for n, t, _ in prediction_columns(features, class_ids)]]
    return Ledger(space, table, tuple(columns), PARTITION).create()


def open_ledger(space: TableSpace, table: str = PREDICTIONS) -> Ledger:
    """The ledger of an existing history, with the columns it was made with."""
    fields = [f for f in space.read(table).schema.fields if f.name != "attempt"]
    return Ledger(space, table, tuple((f.name, f.dataType.simpleString()) for f in fields), PARTITION)


def append_predictions(space: TableSpace, preds: DataFrame, table: str = PREDICTIONS) -> None:
    """Appends by column name, cast to the table's types. Columns must match exactly."""
    wanted = space.read(table).schema
    if set(wanted.names) != set(preds.columns):
        raise ValueError(f"columns differ from {table}: {sorted(set(wanted.names) ^ set(preds.columns))}")
    typed = preds.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])
    space.append(typed, table, [PARTITION])


def write_pointer(space: TableSpace, batch_id: str, ts: datetime) -> None:
    """Remembers the batch just written (one row, replaced every time)."""
    space.overwrite(space.spark.createDataFrame([(batch_id, ts)], "batch_id string, timestamp timestamp"), POINTER)


def read_pointer(space: TableSpace) -> str:
    row = space.read(POINTER).select("batch_id").first() if space.exists(POINTER) else None
    if row is None:
        raise ValueError("no batch id found; run the earlier steps first")
    return row["batch_id"]


def append_metadata(space: TableSpace, stats: DataFrame, ts: datetime) -> None:
    """One row of statistics per batch, kept for good."""
    space.append(stats.withColumn("recorded_at", F.lit(ts).cast("timestamp")), METADATA)
