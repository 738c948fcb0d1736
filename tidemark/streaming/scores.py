"""Structured Streaming forms of scoring and daily profiles."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import clean_double, timestamp
from tidemark.operators.batch import build_predictions
from tidemark.operators.scoring import LinearModel, score
from tidemark.sources.ledger import Ledger
from tidemark.sources.tables import load_parquet


def stream_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Unbounded read of one table of a folder, with the schema of its files.

    The table may be one file or a folder of part files: a stream source wants a folder, so the glob
    lists the part files of the one and names the file of the other.
    """
    rows = load_parquet(spark, folder, table)
    path = f"{folder.rstrip('/')}/{table}.parquet"
    stream = spark.readStream.schema(rows.schema)
    if any(unquote(file).rstrip("/").endswith(f"/{table}.parquet") for file in rows.inputFiles()):
        return stream.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
    return stream.parquet(path)


def score_stream(stream: DataFrame, model: LinearModel, scaler: DataFrame | dict | None = None) -> DataFrame:
    """The batch scoring projection on a stream: stateless, no shuffle."""
    return score(stream, model, scaler)


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), mode: str = "append"
) -> StreamingQuery:
    """Appends everything available to parquet files and stops; restarts resume from ``checkpoint``."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def append_scored_batches(
    ledger: Ledger,
    stream: DataFrame,
    model: LinearModel,
    checkpoint: str,
    scaler: DataFrame | dict | None = None,
    clock: Callable[[], datetime] = datetime.now,
    alias: str = "production",
    key: Sequence[str] = (),
) -> StreamingQuery:
    """Scores each micro-batch and appends it to the prediction ledger under its own batch id.

    The id follows from the checkpoint and the micro-batch number. A micro-batch that is repeated after a restart finds
    itself published in the manifest, or else is written again as a whole: what an interrupted write left is never read.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        batch_id = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint}#{epoch}"))
        scored = score(rows, model, scaler)
        ledger.append(build_predictions(scored, model.features, model.class_ids, batch_id, clock(), alias, key), batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def daily_stream_profile(
    stream: DataFrame,
    ts: str,
    by: Sequence[str] = (),
    value: str | None = None,
    granularity: str = "1 day",
    watermark: str = "1 day",
) -> DataFrame:
    """Tumbling volume (and mean of ``value``) per window; a window is emitted once it is closed."""
    stamped = stream.withColumn("_ts", timestamp(ts)).withWatermark("_ts", watermark)
    measures = [F.count("*").alias("n")] + ([] if value is None else [F.avg(clean_double(value)).alias(f"avg_{value}")])
    windowed = stamped.groupBy(F.window("_ts", granularity).alias("_w"), *by).agg(*measures)
    bounds = [F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")]
    return windowed.select(*bounds, *by, *[c for c in windowed.columns if c not in ("_w", *by)])
