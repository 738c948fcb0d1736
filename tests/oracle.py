"""Side-by-side comparison of a registered query with its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES.split():
        if Path(f"{folder}/{table}.parquet").exists():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_cell(v) for v in row) for row in zip(*columns)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    ours, theirs = df.toArrow(), db.execute(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} vs {sorted(theirs.column_names)}"
    kinds = {n: (ours.schema.field(n).type, theirs.schema.field(n).type) for n in ours.column_names}
    odd = {n: f"{a} vs {b}" for n, (a, b) in kinds.items() if str(a).replace("large_", "") != str(b).replace("large_", "")}
    if odd:
        return f"types {odd}"
    if ours.num_rows != theirs.num_rows:
        return f"{ours.num_rows} rows vs {theirs.num_rows}"
    for a, b in zip(_rows(ours), _rows(theirs)):
        if a != b:
            return f"first difference {a} vs {b}"
    return None
