"""Shared working folder and materialisation of intermediate results."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def workspace_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the workspace root."""
    return f"{workspace_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; survives executor loss and is never recomputed."""
    workspace_root(df.sparkSession)
    return df.checkpoint(eager=True)


def literal_frame(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A few driver-known rows as a local relation, whose size the optimizer sees."""
    return spark.createDataFrame(pa.table(columns))


class Summary:
    """An aggregate computed once and reused several times in the same plan.

    Up to ``limit`` rows it becomes a local relation, proven small enough to broadcast. Beyond that
    it stays distributed (checkpointed) and joins go through a shuffle.
    """

    def __init__(self, df: DataFrame, limit: int = 200_000):
        spark = df.sparkSession
        head = df.limit(limit + 1).toArrow()
        self.small = head.num_rows <= limit
        self.rows: DataFrame = spark.createDataFrame(head, schema=df.schema) if self.small else durable(df)

    def joinable(self, df: DataFrame | None = None) -> DataFrame:
        """``df`` (derived from this summary, no longer than it) with a broadcast hint when proven small."""
        df = self.rows if df is None else df
        return F.broadcast(df) if self.small else df
