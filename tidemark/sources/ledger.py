"""Tables that grow by whole batches: rows are staged under an attempt, a manifest row publishes them.

A batch is written to partitions of its own (load date, attempt) and is seen by nobody until its rows in the manifest
appear, which takes one renamed file. So an append that stops half-way leaves nothing to read, and repeating it under
the same batch id, even beside a writer that was taken for dead, gives every row once: readers take the first published
attempt of a batch. Questions about batches (is it there, how many rows, which days) read the manifest alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import TableSpace
from tidemark.sources.workspace import Summary

MANIFEST = "batch_id string, attempt string, day date, n bigint, published_at timestamp, inputs array<string>"


@dataclass(frozen=True)
class Ledger:
    """A table of ``columns`` (name, type), one of them the load date ``day``, and its manifest."""

    space: TableSpace
    table: str
    columns: tuple[tuple[str, str], ...]
    day: str = "data_carga"

    @property
    def manifest(self) -> str:
        return f"{self.table}_manifest"

    def create(self) -> Ledger:
        space = self.space
        columns = ", ".join(f"`{n}` {t}" for n, t in self.columns)
        space.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {space.name(self.table)} ({columns}, attempt string) USING {space.format} "
            f"PARTITIONED BY (`{self.day}`, attempt)"
        )
        space.spark.sql(f"CREATE TABLE IF NOT EXISTS {space.name(self.manifest)} ({MANIFEST}) USING {space.format}")
        return self

    # writing ------------------------------------------------------------------------------------

    def append(
        self, rows: DataFrame, batch_id: str, published_at: datetime | None = None, inputs: Sequence[str] = ()
    ) -> bool:
        """Appends ``rows`` as one batch, unless it is published already; tells whether it was appended.

        Columns must be those of the table, in any order, and are cast to its types. ``inputs`` names the batches
        of other ledgers that these rows are made from; they are published together with the rows.
        """
        if not self.published().filter(F.col("batch_id") == batch_id).isEmpty():
            return False
        attempt = self.stage(rows)
        self.publish(batch_id, attempt, published_at, inputs)
        return True

    def stage(self, rows: DataFrame) -> str:
        """Writes rows that nobody sees yet; returns the attempt to publish them by."""
        names = [n for n, _ in self.columns]
        if set(names) != set(rows.columns):
            raise ValueError(f"columns differ from {self.table}: {sorted(set(names) ^ set(rows.columns))}")
        attempt = uuid.uuid4().hex
        typed = rows.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in self.columns], F.lit(attempt).alias("attempt"))
        self.space.append(typed, self.table, [self.day, "attempt"])
        return attempt

    def publish(
        self, batch_id: str, attempt: str, published_at: datetime | None = None, inputs: Sequence[str] = ()
    ) -> None:
        """Makes the staged rows of an attempt visible, with their number by day as they are in the table."""
        stamp = published_at or datetime.now(timezone.utc)
        staged = self._rows().filter(F.col("attempt") == attempt).groupBy(F.col(self.day).alias("day")).agg(F.count("*").alias("n"))
        # a batch without rows is published too: it has been dealt with
        whole = self.space.spark.range(1).select(F.lit(None).cast("date").alias("day"), F.lit(0).cast("bigint").alias("n"))
        found = whole.unionByName(staged).select(
            F.lit(batch_id).alias("batch_id"),
            F.lit(attempt).alias("attempt"),
            "day",
            "n",
            F.lit(stamp).cast("timestamp").alias("published_at"),
            F.when((F.col("n") == 0) & F.col("day").isNull(), F.lit(list(inputs)).cast("array<string>")).alias("inputs"),
        )
        # one task, one file, one rename
        self.space.append(found.coalesce(1), self.manifest)

    # reading ------------------------------------------------------------------------------------

    def _rows(self) -> DataFrame:
        self.space.spark.catalog.refreshTable(self.space.name(self.table))
        return self.space.read(self.table)

    def published(self) -> DataFrame:
        """Manifest rows (one per batch and day, and one without day) of the first attempt of each batch."""
        self.space.spark.catalog.refreshTable(self.space.name(self.manifest))
        first = Window.partitionBy("batch_id").orderBy("published_at", "attempt")
        return self.space.read(self.manifest).withColumn("_place", F.dense_rank().over(first)).filter("_place = 1").drop("_place")

    def days(self) -> DataFrame:
        """Rows (day, batches, n) from the manifest alone."""
        return self.published().filter("n > 0").groupBy("day").agg(F.count("*").alias("batches"), F.sum("n").alias("n"))

    def inputs(self) -> DataFrame:
        """The batches of other ledgers that the published ones are made from."""
        return self.published().select(F.explode("inputs").alias("input")).distinct()

    def last_batch(self) -> tuple[str, date | None, date | None]:
        """Id, first and last day of the batch published last."""
        order = F.struct("published_at", "attempt")
        newest = self.published().groupBy("batch_id", "attempt", "published_at").agg(F.min("day").alias("low"), F.max("day").alias("high"))
        row = newest.agg(F.max_by(F.struct("batch_id", "low", "high"), order).alias("r")).first()["r"]
        if row is None:
            raise ValueError(f"no batch in {self.table}; run the earlier steps first")
        return row["batch_id"], row["low"], row["high"]

    def read(self, since: date | str | None = None, until: date | str | None = None, batches: DataFrame | None = None) -> DataFrame:
        """Published rows of the days ``since`` to ``until``, of the manifest rows ``batches`` only where given.

        Both reach the files as partition filters: the days as literals, the attempts through the join with the
        manifest, which is broadcast only where Spark measures it small.
        """
        wanted = self.published() if batches is None else batches
        wanted = wanted.filter(self._between("day", since, until)).filter("n > 0").select("attempt").distinct()
        rows = self._rows().filter(self._between(self.day, since, until))
        return rows.join(wanted, "attempt", "left_semi").select(*[F.col(f"`{n}`") for n, _ in self.columns])

    def read_batch(self, batch_id: str) -> DataFrame:
        """Published rows of one batch; the days its manifest rows name prune the partitions."""
        own = Summary(self.published().filter(F.col("batch_id") == batch_id)).rows
        low, high = own.agg(F.min("day"), F.max("day")).first()
        return self.read(low, high, own)

    @staticmethod
    def _between(name: str, since: date | str | None, until: date | str | None) -> Column:
        kept = F.lit(True)
        if since is not None:
            kept = kept & (F.col(name) >= F.lit(since).cast("date"))
        if until is not None:
            kept = kept & (F.col(name) <= F.lit(until).cast("date"))
        return kept
