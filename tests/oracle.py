"""Compare Spark results with DuckDB's, row by row, on the given tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    """Multiset of rows with columns in name order; NaN is equal to itself."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(df, con, sql) -> str:
    """Empty when both sides have the same columns and rows."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} and {sorted(columns)}"
    expected = rows_of(columns, result.fetchall())
    found = rows_of(df.columns, df.collect())
    if expected == found:
        return ""
    extra, absent = found - expected, expected - found
    return (
        f"{sum(found.values())} rows found, {sum(expected.values())} expected;"
        f" e.g. found {list(extra)[:2]}, expected {list(absent)[:2]}"
    )
