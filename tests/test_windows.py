"""Windows on a stream: closed ones, and rows that came after."""

import math
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tidemark.streaming.windows import accounted_windows, write_windows

SCHEMA = "ts timestamp_ntz, kind string, v double"
START = datetime(2024, 1, 1)


def run(spark, folder, files, by=("kind",), value="v", **options):
    for part in files:
        rows = [(None if d is None else START + timedelta(days=d), k, v) for d, k, v in part]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        import time

        time.sleep(1.05)  # files are taken in the order of their seconds
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    windows = accounted_windows(stream, "ts", by, value, **options)
    write_windows(windows, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{folder}/out")


def brute(files, delay=1.0):
    """(kind, day, late) -> (n, known, total); the watermark follows the files before."""
    sums, open_, mark = defaultdict(lambda: [0, 0, 0.0]), defaultdict(lambda: [0, 0, 0.0]), -1e9
    for part in files:
        for d, k, v in part:
            day = None if d is None else math.floor(d)
            held = sums[k, day, True] if day is None or day + 1 <= mark else open_[k, day]
            held[0] += 1
            if v is not None and v == v:
                held[1] += 1
                held[2] += v
        mark = max([mark, *[d - delay for d, _, _ in part if d is not None]])
    for (k, day), held in open_.items():
        if day + 1 <= mark:
            sums[k, day, False] = held
    return {key: tuple(held) for key, held in sums.items()}


NAN = float("nan")
FILES = [
    [(0.1, "a", 1.0), (0.2, "a", NAN), (0.3, "b", None), (3.2, "a", 5.0), (None, "a", 1.0)],
    [(0.5, "a", 2.0), (2.9, "b", 3.0), (3.1, None, 4.0), (4.9, "a", 1.5)],
    [(0.6, "a", 7.0), (1.1, "b", 8.0)],
    [(9.5, "c", 1.0), (3.7, "a", 0.5), (None, None, NAN)],
    [(0.7, "a", 9.0), (9.7, "c", 2.0), (12.0, "a", 1.0)],
]


def test_every_row_is_counted_once(spark, tmp_path):
    found = run(spark, tmp_path, FILES).collect()
    sums = defaultdict(lambda: [0, 0, 0.0])
    for r in found:
        day = None if r["window_start"] is None else (r["window_start"] - START).days
        held = sums[r["kind"], day, r["late"]]
        held[0] += r["n"]
        held[1] += r["known"]
        held[2] += r["total"]
        assert day is None or r["window_end"] - r["window_start"] == timedelta(days=1)
    assert {k: tuple(v) for k, v in sums.items()} == brute(FILES)
    closed = [(r["kind"], r["window_start"]) for r in found if not r["late"]]
    assert len(closed) == len(set(closed)) and any(r["late"] and r["window_start"] for r in found)


def test_without_groups_and_values(spark, tmp_path):
    found = run(spark, tmp_path, [[(0.0, "a", 1.0), (0.4, "b", 1.0), (5.0, "a", 1.0)]], by=(), value=None, width=timedelta(hours=12), delay=timedelta(0))
    rows = {(r["window_start"] - START) / timedelta(hours=12): (r["n"], r["known"], r["late"]) for r in found.collect()}
    assert rows == {0.0: (2, 0, False)}


def test_restart_goes_on_with_open_windows(spark, tmp_path):
    first = run(spark, tmp_path, FILES[:2]).count()
    again = run(spark, tmp_path, FILES[2:]).collect()
    assert len(again) > first
    total = sum(r["n"] for r in again)
    assert total == sum(n for n, _, _ in brute(FILES).values())


def test_setting_of_the_state_store_is_put_back(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    run(spark, tmp_path, [[(0.0, "a", 1.0)]])
    assert spark.conf.get(name, None) == before


@pytest.mark.parametrize("rows", [[], [(None, "a", 1.0)]])
def test_streams_without_times(spark, tmp_path, rows):
    found = run(spark, tmp_path, [rows]).collect()
    assert [(r["n"], r["late"], r["window_start"]) for r in found] == [(1, True, None)] * len(rows)
