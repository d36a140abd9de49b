"""Compare a query with its SQL on the same Parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return str(value) if value is not None else None


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return sorted(df.columns), sorted_rows(df.columns, df.collect())


def sql_rows(db, sql):
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), sorted_rows(columns, result.fetchall())
