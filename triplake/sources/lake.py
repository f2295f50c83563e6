"""Silver and quarantine: clean rows and rejected rows as Parquet, in snapshots.

``write_split`` writes both in one pass over the input, as one version of a dataset
whose parts are ``verdict=clean`` and ``verdict=quarantine``, below each of them one
part per month. ``write_separate`` writes two datasets at two paths, the second flat,
and scans the input once for each. Either way nothing changes for readers before the
version is committed, so a write that fails leaves all old rows.

Neither shuffles when trips come from bronze. The wrong-month rule leaves each
object's clean rows in a single month, so a task that reads one object writes one
clean file, and a month with a third of all rows is still written by as many tasks
as read it. Where months are spread over the whole input, every task would write a
file for each of them; ``gather`` brings a month's rows together first.

A run replaces the whole dataset, or with ``months`` what came of the objects of those
months; the parts of all others stay with the runs that hold them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from triplake.functions.trips import partition_month
from triplake.operators.quality import (
    CLEAN,
    QUARANTINE,
    VERDICT,
    Rule,
    audit_columns,
    judge,
    split,
)
from triplake.sources.snapshots import CommitLog, Snapshot

MONTH, SOURCE_MONTH = "partition_month", "source_month"


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows shuffled by ``columns`` into partitions of even size.

    Spark splits a value with many rows over several partitions and merges the
    small ones, so a hot month costs no single long task.
    """
    return df.hint("rebalance", *columns)


def write_split(
    df: DataFrame,
    rules: list[Rule],
    root: str,
    null_verdict: str = "drop",
    gather: bool = False,
    months: Sequence[str] | None = None,
    derived: Mapping[str, Callable[[], Column]] = {},
) -> dict[str, int]:
    """Judge ``df`` and write clean and quarantined rows under ``root``.

    ``derived`` columns are made from the others once these are shuffled, if they are, so
    that a long text such as a key is not shuffled with each row.
    ``months`` names source months: only their rows are taken, and only what is stored
    of those months is replaced, also where nothing is left. It needs rules that keep
    clean rows in their object's month. Returns the row counts. They come from the
    writing tasks themselves (after a shuffle, if any), which Spark counts once per
    partition, also when lost tasks run again.
    """
    if months is not None:
        df = df.filter(F.col(SOURCE_MONTH).isin(list(months)))
    rows, folders = judge(df, rules, null_verdict), [VERDICT]
    if MONTH in df.columns:
        # Bad pickup times make any number of months, so quarantined rows are held by
        # the month of their object; read_quarantine derives their own again.
        came = F.col(SOURCE_MONTH) if SOURCE_MONTH in df.columns else F.lit(None)
        rows = rows.withColumn(MONTH, F.when(F.col(VERDICT) == CLEAN, F.col(MONTH)).otherwise(came))
        folders.append(MONTH)
    rows = rows.drop(SOURCE_MONTH)
    if gather:
        rows = gathered(rows, *folders)
    counts = Observation("split")
    kept = rows.observe(counts, *audit_columns(F.col(VERDICT))).filter(F.col(VERDICT).isNotNull())
    ends = tuple(f"/{MONTH}={month}" for month in months or ())
    kept = kept.withColumns({name: made() for name, made in derived.items()})
    log = CommitLog(df.sparkSession, root)
    log.write(kept, *folders, replaced=lambda part: months is None or part.endswith(ends))
    return dict(counts.get)


def write_separate(
    df: DataFrame,
    rules: list[Rule],
    clean_path: str,
    quarantine_path: str,
    null_verdict: str = "drop",
    gather: bool = False,
    derived: Mapping[str, Callable[[], Column]] = {},
) -> dict[str, int]:
    """Write clean rows (by month, if they have one) and quarantined rows apart. ``derived``
    columns are those of ``write_split``."""
    parts = split(df, rules, null_verdict)
    folders = [MONTH] if MONTH in df.columns else []
    written = {}
    for name, part, path, by in (
        ("n_clean", parts.clean, clean_path, folders),
        ("n_quarantined", parts.quarantine, quarantine_path, []),
    ):
        rows = part.drop("source_month")
        if gather and by:
            rows = gathered(rows, *by)
        rows = rows.withColumns({column: made() for column, made in derived.items()})
        count = Observation(name)
        CommitLog(df.sparkSession, path).write(rows.observe(count, F.count(F.lit(1)).alias("n")), *by)
        written[name] = count.get["n"]
    return written


def read_clean(
    spark: SparkSession, root: str, schema: StructType, snapshot: Snapshot | None = None
) -> DataFrame:
    """Clean rows of ``write_split``; a filter on the month reads that month only.

    All reads are bound to one snapshot, by default to the newest one there is.
    """
    return _read_verdict(spark, root, schema, CLEAN, snapshot)


def read_quarantine(
    spark: SparkSession, root: str, schema: StructType, snapshot: Snapshot | None = None
) -> DataFrame:
    rows = _read_verdict(spark, root, schema, QUARANTINE, snapshot)
    return rows.withColumn(MONTH, partition_month()) if MONTH in schema.names else rows


def read_dataset(
    spark: SparkSession, path: str, schema: StructType, snapshot: Snapshot | None = None
) -> DataFrame:
    """One dataset of ``write_separate``. The schema keeps the month a string."""
    return CommitLog(spark, path).read(schema, _committed(spark, path, snapshot))


def _committed(spark: SparkSession, root: str, snapshot: Snapshot | None) -> Snapshot:
    snapshot = snapshot or CommitLog(spark, root).latest()
    if not snapshot.version:
        raise FileNotFoundError(f"nothing was committed at {root}")
    return snapshot


def _read_verdict(spark, root, schema, verdict, snapshot) -> DataFrame:
    stored = StructType([*schema.fields, StructField(VERDICT, StringType())])
    rows = CommitLog(spark, root).read(stored, _committed(spark, root, snapshot))
    return rows.filter(F.col(VERDICT) == verdict).select(*schema.names)
