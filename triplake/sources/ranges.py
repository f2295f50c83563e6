"""First and last value of a column in each stored file, kept to prune reads by.

Parquet keeps such bounds in each file's footer, which a reader opens file by file. Kept as
rows beside the dataset, they tell which files a read needs before any of them is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE, FIRST, LAST, ROWS = "file_name", "first_value", "last_value", "n_rows"


def file_ranges(stored: DataFrame, column: str, *by: str) -> DataFrame:
    """A row for each file of ``stored``, a plain read of Parquet partitioned ``by``. One
    aggregation, which reads a single column. Files that hold only NULLs have no bounds."""
    bounds = [F.min(column).alias(FIRST), F.max(column).alias(LAST), F.count(F.lit(1)).alias(ROWS)]
    return stored.groupBy(*by, F.col("_metadata.file_name").alias(FILE)).agg(*bounds)


def overlaps(start: Column, end: Column) -> Column:
    """Whether a file may hold values from ``start`` up to but without ``end``."""
    return (F.col(LAST) >= start) & (F.col(FIRST) < end)


def files_of(rows: DataFrame, rows_per_file: int) -> int:
    """Number of files that hold ``rows_per_file`` rows each, from a count of ``rows``."""
    if rows_per_file < 1:
        raise ValueError(f"rows_per_file must be 1 or more: {rows_per_file}")
    return max(1, -(-rows.count() // rows_per_file))
