"""Tumbling windows on a stream that account for every row: closed windows, and rows that came after theirs had closed.

Each task first adds up its rows by key and window, so a key with a third of all rows sends a few sums. Every (key,
window) has its own small state: its sums until the watermark passes its end, when a timer emits them. What arrives
later is not dropped but emitted as late, with the same sums. Totals and late sums of a window together are exactly a
``GROUP BY`` of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions.columns import clean_double, timestamp

#: State with timers lives in this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUMS = "n long, known long, total double"


def _by_text(by: Sequence[str]) -> list:
    return [F.col(c).cast("string").alias(c) for c in by]


class _Window(StatefulProcessor):
    """Sums of one (key, window) until the watermark reaches its end."""

    def __init__(self, width: int, names: list[str]):
        self.width, self.names = width, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", SUMS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, closed = key[-1], timerValues.getCurrentWatermarkInMs()
        if start == MARK:
            return
        n, known, total = 0, 0, 0.0
        for part in rows:
            n, known, total = n + int(part["n"].sum()), known + int(part["known"].sum()), total + float(part["total"].sum())
        # rows without a time have no window: they are late for any
        if start == UNKNOWN or start + self.width <= closed:
            yield self._out(key, n, known, total, True)
            return
        if self.sums.exists():
            before = self.sums.get()
            n, known, total = n + before[0], known + before[1], total + before[2]
        else:
            self.handle.registerTimer(start + self.width)
        self.sums.update((n, known, total))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._out(key, *self.sums.get(), False)
        self.sums.clear()

    def _out(self, key, n, known, total, late) -> pd.DataFrame:
        row = [*key[:-1], None if key[-1] == UNKNOWN else key[-1], n, known, total, late]
        return pd.DataFrame([row], columns=[*self.names, "_start", "n", "known", "total", "late"]).astype({"_start": "Int64"})

    def close(self) -> None:
        pass


#: Window starts that are none: rows without a time, and the rows that only carry the watermark.
UNKNOWN, MARK = -(1 << 62), -(1 << 62) + 1


def accounted_windows(
    stream: DataFrame,
    ts: str,
    by: Sequence[str] = (),
    value: str | None = None,
    width: timedelta = timedelta(days=1),
    delay: timedelta = timedelta(days=1),
) -> DataFrame:
    """Rows (*by as text, window_start, window_end, n, known, total, late).

    A row with late = false is a window that closed: its rows, those with a known ``value`` (not NULL, not NaN), and
    their sum. A row with late = true has the same sums of rows that came when the watermark (greatest time of the
    micro-batches before, less ``delay``) had reached the end of their window, or that have no time (then without
    window). A late window may have several such rows.
    """
    by, step = list(by), int(width.total_seconds() * 1000)
    ms = F.unix_millis(timestamp(ts).cast("timestamp"))
    number = F.lit(None).cast("double") if value is None else clean_double(value)
    rows = stream.select(*_by_text(by), ms.alias("_ms"), number.alias("_v"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.to_pandas()
            latest = rows["_ms"].max()
            start = (rows["_ms"] // step * step).fillna(UNKNOWN).astype("int64")
            sums = rows.assign(_start=start, known=rows["_v"].notna().astype("int64"), n=1).groupby([*by, "_start"], dropna=False, sort=False)
            sums = sums.agg(n=("n", "sum"), known=("known", "sum"), total=("_v", "sum")).reset_index()
            sums["_mark"] = None
            columns = [pa.array(sums[c], pa.string(), from_pandas=True) for c in by]
            columns += [pa.array(sums["_start"], pa.int64()), pa.array(sums["n"], pa.int64()), pa.array(sums["known"], pa.int64()), pa.array(sums["total"], pa.float64()), pa.nulls(len(sums), pa.int64())]
            yield pa.record_batch(columns, schema=combined)
            if pd.notna(latest):
                # the watermark follows these rows only: sums without a time are never taken for late ones and dropped
                mark = [pa.nulls(1, pa.string()) for _ in by]
                mark += [pa.array([v], t) for v, t in ((MARK, pa.int64()), (0, pa.int64()), (0, pa.int64()), (0.0, pa.float64()), (int(latest), pa.int64()))]
                yield pa.record_batch(mark, schema=combined)

    combined = pa.schema([*[(c, pa.string()) for c in by], ("_start", pa.int64()), ("n", pa.int64()), ("known", pa.int64()), ("total", pa.float64()), ("_mark", pa.int64())])
    texts = "".join(f"`{c}` string, " for c in by)
    sums = rows.mapInArrow(combine, f"{texts}_start long, {SUMS}, _mark long")
    marked = sums.withColumn("_mark", F.timestamp_millis("_mark")).withWatermark("_mark", f"{int(delay.total_seconds() * 1000)} milliseconds")
    found = marked.groupBy(*by, "_start").transformWithStateInPandas(
        _Window(step, by), f"{texts}_start long, {SUMS}, late boolean", "append", "EventTime"
    )
    start = F.timestamp_millis("_start")
    return found.select(*by, start.alias("window_start"), F.timestamp_millis(F.col("_start") + step).alias("window_end"), "n", "known", "total", "late")


def write_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes everything available and stops: closed windows to ``path/late=false``, late sums to ``path/late=true``."""
    conf, name = windows.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, STATE_STORE)
    try:
        writer = windows.writeStream.format("parquet").outputMode("append").option("path", path).partitionBy("late")
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.unset(name) if before is None else conf.set(name, before)
