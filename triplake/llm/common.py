"""What the operators share: tables, shared storage, deterministic choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there.

    A lost executor costs the tasks that it ran, not the work behind this point.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SMALL_ROWS, SMALL_BYTES = 200_000, 32 << 20


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it is counted to be small, else as it is, for
    Spark to join by shuffle. It should be stored, as it is read twice."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


# Keys that count as frequent, at most.
FREQUENT = 4096


def join_counted(rows: DataFrame, lookup: DataFrame, key: str, count: str = "n") -> DataFrame:
    """Inner join with a lookup of one row for each key, which counts the key's ``rows``.

    Keys with more than a 4096th of all counted rows, of which there are no more than
    4096, are broadcast: their rows stay where they are. The others are joined by shuffle,
    or broadcast as well where they are counted to be few.
    ``rows`` and ``lookup`` should be stored, as both are read for either part.
    """
    total = lookup.agg(F.sum(count)).first()[0] or 0
    often = F.col(count) > total / FREQUENT
    frequent = F.broadcast(lookup.filter(often))
    known = rows.join(frequent, key)
    rest = rows.join(frequent.select(key), key, "left_anti").join(small_side(lookup.filter(~often)), key)
    return known.unionByName(rest)


def text_of(column: str = "text") -> Column:
    """The text, where a NULL counts as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def bounded_sample(df: DataFrame, limit: int, *order: str) -> DataFrame:
    """At most ``limit`` rows, the same ones at every run: least by hash, then value.

    Spark keeps ``limit`` rows in each task, and those only, before it merges them.
    """
    by = [F.xxhash64(*(F.col(c) for c in order)), *(F.col(c) for c in order)]
    return df.orderBy(*by).limit(limit)


def hash_uniform(*columns: Column) -> Column:
    """A number in [0, 1) fixed by the values."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double") / float(1 << 52)
