"""Raw layer: typed load targets with a NOT NULL contract, and their loads.

Targets are the tables of a database folder, or tables of any database through JDBC. One
commit log says which runs hold which month of which table, so all tables move to new
content in one step, and a reader who asks for a snapshot never sees two loads mixed. The
catalog's names follow the log: each month and run is a partition at its own place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from triplake.functions.trips import month_key
from triplake.schemas import RAW_TRIPS, RAW_ZONES
from triplake.session import sortable_scans
from triplake.sources.objects import file_system
from triplake.sources.ranges import FILE, FIRST, LAST, ROWS, file_ranges, files_of, overlaps
from triplake.sources.snapshots import RUN, CommitLog, Snapshot

TRIPS_TABLE, ZONES_TABLE = "raw_trips", "raw_zones"
MONTH_KEY = "month_key"

# Order of the rows in each file.
PICKUP = "tpep_pickup_datetime"
TRIPS_ORDER = (MONTH_KEY, PICKUP, "PULocationID")
ZONES_ORDER = ("LocationID",)

# Pickup times of each file of the trips, where a load was asked to make them narrow.
RANGES_TABLE = f"{TRIPS_TABLE}_ranges"
OF_RUN = "of_run"
# Rows of a file of some 128 MiB.
ROWS_PER_FILE = 4_000_000
RANGES = StructType(
    [
        StructField(OF_RUN, StringType()),
        StructField(FILE, StringType()),
        StructField(FIRST, TimestampNTZType()),
        StructField(LAST, TimestampNTZType()),
        StructField(ROWS, LongType()),
        StructField(MONTH_KEY, LongType()),
    ]
)

# Schema and partition column of each table.
TABLES = {TRIPS_TABLE: (RAW_TRIPS, MONTH_KEY), ZONES_TABLE: (RAW_ZONES, None)}
# Folder that tells the tables of a database apart.
TABLE = "_table"
# In the names of tables that are derived from raw rows month by month. A load takes out
# what it makes stale, in the same step.
DERIVED = "_parts_"

# What a NULL in a NOT NULL column does.
ON_NULL = ("fail", "default", "reject")
# Bits of the required columns that are NULL in a rejected row, the first column's lowest.
BROKEN = "_broken"


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database, and the raw tables where the catalog does not have them.

    ``location`` is a folder all executors share; without it the catalog's own
    warehouse is used. Tables are external: a catalog that lives as long as its
    session finds what an earlier one has loaded in the same folder.
    """
    at = " LOCATION '{}'".format(location.replace("'", "\\'")) if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    snapshot = table_log(spark, database).latest()
    for table in TABLES:
        if not spark.catalog.tableExists(f"`{database}`.`{table}`"):
            register(spark, database, table, snapshot)


def table_log(spark: SparkSession, database: str) -> CommitLog:
    """The log of all tables of a database."""
    return CommitLog(spark, spark.catalog.getDatabase(f"`{database}`").locationUri)


def part_prefix(table: str) -> str:
    return f"{TABLE}={table}"


def holds(table: str, months: Iterable[int] | None = None) -> Callable[[str], bool]:
    """Whether a part is of a table, and of certain months where they are named."""
    prefix = part_prefix(table)
    if months is None:
        return lambda part: part == prefix or part.startswith(f"{prefix}/")
    return {f"{prefix}/{MONTH_KEY}={month}" for month in months}.__contains__


def months_of(snapshot: Snapshot, table: str) -> set[int]:
    """Months that a table has rows of."""
    return {int(part.rpartition("=")[2]) for part in snapshot.parts if holds(table)(part) and "/" in part}


def _stale(months: Iterable[int] | None = None) -> Callable[[str], bool]:
    """Whether a part was derived from raw rows that change: of all months, or of some."""
    ends = None if months is None else tuple(f"/{MONTH_KEY}={month}" for month in months)
    return lambda part: DERIVED in part and (ends is None or part.endswith(ends))


def read_table(
    spark: SparkSession, database: str, table: str, snapshot: Snapshot | None = None
) -> DataFrame:
    """A raw table as of a snapshot, the newest one by default. Tables read as of one
    snapshot belong together, whatever is loaded meanwhile."""
    schema, partition = TABLES[table]
    more = [StructField(partition, LongType())] if partition else []
    return table_log(spark, database).read(StructType([*schema, *more]), snapshot, holds(table))


def read_ranges(spark: SparkSession, database: str, snapshot: Snapshot | None = None) -> DataFrame:
    """The files of the trips whose pickup times were kept by their load."""
    return table_log(spark, database).read(RANGES, snapshot, holds(RANGES_TABLE))


def read_slice(
    spark: SparkSession,
    database: str,
    start: datetime,
    end: datetime,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """Trips picked up from ``start`` up to but without ``end``, as of a snapshot. Both are
    times without a zone, as pickup times are.

    Only months of the slice are looked at, and of these only the files whose kept pickup
    times meet it; the driver sees the names of those files, which the scan lists anyway.
    Runs that were loaded without such ranges are read as they are, by the month.
    """
    log = table_log(spark, database)
    snapshot = snapshot or log.latest()
    schema = StructType([*RAW_TRIPS, StructField(MONTH_KEY, LongType())])
    if start.tzinfo or end.tzinfo:
        raise ValueError(f"times with a zone: {start}, {end}")
    # Spark takes a Python time for one of the session's zone, text for one without.
    begin, until = (F.lit(at.isoformat(" ")).cast(TimestampNTZType()) for at in (start, end))
    first, last = (at.year * 100 + at.month for at in (start, end - timedelta(microseconds=1)))
    months = [m for m in months_of(snapshot, TRIPS_TABLE) if first <= m <= last]
    mine = holds(TRIPS_TABLE, months)
    folders = {(run, part) for part, runs in snapshot.parts.items() if mine(part) for run in runs}
    ranges = log.read(RANGES, snapshot, holds(RANGES_TABLE, months))
    known = {(run, _month_part(month)) for run, month in ranges.select(OF_RUN, MONTH_KEY).distinct().collect()}
    met = ranges.filter(overlaps(begin, until)).select(OF_RUN, MONTH_KEY, FILE).collect()
    paths = [f"{run}/{_month_part(month)}/{name}" for run, month, name in met]
    paths += [f"{run}/{part}" for run, part in folders - known]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", log.data)
    rows = reader.parquet(*(f"{log.data}/{path}" for path in sorted(paths))).select(*(f"`{n}`" for n in schema.names))
    return rows.filter((F.col(PICKUP) >= begin) & (F.col(PICKUP) < until))


def _month_part(month: int) -> str:
    return f"{part_prefix(TRIPS_TABLE)}/{MONTH_KEY}={month}"


def register(spark: SparkSession, database: str, table: str, snapshot: Snapshot) -> None:
    """Have the table's name mean what a snapshot holds. Partition columns are the month,
    if the table has one, and the run that brought the rows."""
    schema, partition = TABLES[table]
    log, name = table_log(spark, database), f"`{database}`.`{table}`"
    kinds = ([f"`{partition}` BIGINT"] if partition else []) + [f"`{RUN}` STRING"]
    by = ", ".join(k.split()[0] for k in kinds)
    columns = ", ".join([*map(_column_ddl, schema), *kinds])
    at, fs = file_system(spark, f"{log.root}/{table}")
    fs.mkdirs(at)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{_quoted(at.toString())}'")
    parts = {part: runs for part, runs in snapshot.parts.items() if holds(table)(part)}
    _add_partitions(spark, log, name, parts)
    _measure(spark, database, table)


def _measure(spark: SparkSession, database: str, table: str) -> None:
    """Have the planner know the size of a lookup, from its listing, so that it is
    broadcast if it is small; tables by month are never to be."""
    if not TABLES[table][1]:
        spark.sql(f"ANALYZE TABLE `{database}`.`{table}` COMPUTE STATISTICS NOSCAN")


def _quoted(text: str) -> str:
    return text.replace("'", "\\'")


def _spec(part: str, run: str) -> str:
    month = part.partition("/")[2]
    values = ([f"`{MONTH_KEY}`={month.partition('=')[2]}"] if month else []) + [f"`{RUN}`='{run.partition('=')[2]}'"]
    return f"PARTITION ({', '.join(values)})"


def _add_partitions(spark: SparkSession, log: CommitLog, name: str, parts: dict[str, list[str]]) -> None:
    places = [
        f"{_spec(part, run)} LOCATION '{_quoted(f'{log.data}/{run}/{part}')}'"
        for part, runs in parts.items()
        for run in runs
    ]
    if places:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(places)}")


def exchange(spark: SparkSession, database: str, table: str, before: Snapshot, after: Snapshot) -> None:
    """Have the table's name follow from one snapshot to another: only the partitions that
    differ are dropped and added."""
    log, name = table_log(spark, database), f"`{database}`.`{table}`"

    def places(snapshot: Snapshot) -> set[tuple[str, str]]:
        mine = holds(table)
        return {(part, run) for part, runs in snapshot.parts.items() if mine(part) for run in runs}

    old, new = places(before), places(after)
    gone = ", ".join(_spec(*place) for place in sorted(old - new))
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    _add_partitions(spark, log, name, {part: [run] for part, run in sorted(new - old)})
    spark.catalog.refreshTable(name)
    _measure(spark, database, table)


def _column_ddl(field: StructField) -> str:
    null = "" if field.nullable else " NOT NULL"
    return f"`{field.name}` {field.dataType.simpleString()}{null}"


def to_types(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the table's columns, order and types. NULLs stay as they are."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def to_contract(df: DataFrame, schema: StructType, on_null: str = "fail") -> DataFrame:
    """``df`` in the table's columns, order and types, with its NOT NULL rule kept.

    Parquet tables do not enforce NOT NULL, so each row is checked as it is
    written: the first NULL fails the job, or becomes the type's default.
    """
    if on_null not in ON_NULL[:2]:
        raise ValueError(f"on_null must be one of {ON_NULL[:2]} here: {on_null}")
    rows, required = to_types(df, schema), [f for f in schema if not f.nullable]
    if on_null == "default":
        values = {f.name: F.coalesce(F.col(f.name), _default(f.dataType)) for f in required}
        return rows.withColumns(values)
    if not required:
        return rows
    # A filter, as reading few of the columns prunes a check that hangs on one of
    # them; and one check for the row, as one for each column makes the generated
    # method longer than the JVM compiles.
    broken = reduce(or_, (F.col(f.name).isNull() for f in required))
    names = ", ".join(f.name for f in required)
    error = F.raise_error(F.lit(f"NULL in a NOT NULL column, one of: {names}"))
    return rows.filter(F.when(broken, error.cast("boolean")).otherwise(F.lit(True)))


def broken_bits(schema: StructType) -> Column:
    """A bit for each required column that is NULL."""
    required = [f.name for f in schema if not f.nullable]
    bits = [F.when(F.col(name).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(required)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def _default(data_type: DataType) -> Column:
    if isinstance(data_type, StringType):
        return F.lit("")
    if isinstance(data_type, NumericType):
        return F.lit(0).cast(data_type)
    return F.lit("1970-01-01 00:00:00").cast(data_type)


def null_counts(df: DataFrame, schema: StructType) -> DataFrame:
    """One row: how many NULLs stand in each column that must have none."""
    required = [f.name for f in schema if not f.nullable]
    return df.agg(*(F.count_if(F.col(n).isNull()).alias(n) for n in required))


def lay_out_trips(df: DataFrame, files: int | None = None) -> DataFrame:
    """Rows sorted by month, pickup time and pickup zone within each file.

    By default there is no shuffle: silver is already held by month, so its
    tasks sort and write what they read. With ``files`` rows are first split
    into that many key ranges of about equal depth, between quantiles that Spark
    samples, which makes the files' time ranges narrow.
    """
    keyed = df.withColumn(MONTH_KEY, month_key())
    first = [TABLE] if TABLE in df.columns else []
    if files is not None:
        # Many trips, even exact copies, can share a key; the row's position
        # breaks the tie, so that a hot key is spread over several ranges. It
        # needs an input whose row order is fixed, such as a file scan.
        ranged = keyed.withColumn("_position", F.monotonically_increasing_id())
        keyed = ranged.repartitionByRange(files, *TRIPS_ORDER, "_position").drop("_position")
    return keyed.sortWithinPartitions(*first, *TRIPS_ORDER)


def rejects(table: str) -> str:
    """The table of rows that broke the NOT NULL rule of ``table``."""
    return f"{table}_rejects"


def read_rejects(spark: SparkSession, database: str, table: str, snapshot: Snapshot | None = None) -> DataFrame:
    """Rows that loads with ``on_null="reject"`` kept out, with their broken columns."""
    schema, partition = TABLES[table]
    fields = [StructField(f.name, f.dataType) for f in schema] + [StructField(BROKEN, LongType())]
    more = [StructField(partition, LongType())] if partition else []
    return table_log(spark, database).read(StructType([*fields, *more]), snapshot, holds(rejects(table)))


def truncate(spark: SparkSession, database: str) -> None:
    names = [t for t in TABLES if spark.catalog.tableExists(f"`{database}`.`{t}`")]
    if not names:
        return
    stale = _stale()
    gone = [stale, *(holds(t) for t in names), *(holds(rejects(t)) for t in names), holds(RANGES_TABLE)]
    empty = table_log(spark, database).commit({}, lambda part: any(of(part) for of in gone))
    for table in names:
        register(spark, database, table, empty)


def laid_out(table: str, silver: DataFrame, on_null: str = "fail", files: int | None = None) -> DataFrame:
    """Silver rows as their raw table stores them. With ``reject``, rows that break the
    contract are marked and go to a table of their own, in the same pass."""
    schema = TABLES[table][0]
    if on_null == "reject":
        rows = to_types(silver, schema).withColumn(BROKEN, broken_bits(schema))
        target = F.when(F.col(BROKEN) == 0, table).otherwise(F.lit(rejects(table)))
        rows = rows.withColumn(TABLE, target)
    else:
        rows = to_contract(silver, schema, on_null)
    if table == TRIPS_TABLE:
        return lay_out_trips(rows, files)
    return rows.sortWithinPartitions(*(c for c in (TABLE, *ZONES_ORDER) if c in rows.columns))


def _counted(rows: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """``rows``, and how many were loaded, once they are: counted in the writing tasks,
    after any shuffle."""
    count = Observation("loaded")
    kept = F.count_if(F.col(BROKEN) == 0) if BROKEN in rows.columns else F.count(F.lit(1))
    return rows.observe(count, kept.alias("n")), lambda: count.get["n"]


def write_run(log: CommitLog, table: str, rows: DataFrame, partition: str | None) -> tuple[str, list[str]]:
    """Write a table's rows to a run of their own; the run and its parts. No reader sees
    them before they are committed."""
    run, prefix = log.new_run(), part_prefix(table)
    if TABLE in rows.columns:
        columns = [TABLE, *filter(None, [partition])]
        with sortable_scans(log.spark):
            rows.write.partitionBy(*columns).parquet(log.path(run))
        return run, log.parts_of(run, len(columns))
    with sortable_scans(log.spark):
        rows.write.partitionBy(*filter(None, [partition])).parquet(f"{log.path(run)}/{prefix}")
    return run, log.parts_of(run, 2) if partition else [prefix]


def write_ranges(log: CommitLog, run: str, parts: list[str]) -> dict[str, list[str]]:
    """Write the pickup times of the files of a run of trips, as a run of its own, to be
    committed with it."""
    if not any(holds(TRIPS_TABLE)(part) for part in parts):
        return {}
    stored = StructType([RAW_TRIPS[PICKUP], StructField(MONTH_KEY, LongType())])
    reader = log.spark.read.schema(stored).option("basePath", log.data)
    ranges = file_ranges(reader.parquet(f"{log.path(run)}/{part_prefix(TRIPS_TABLE)}"), PICKUP, MONTH_KEY)
    rows = ranges.withColumn(OF_RUN, F.lit(run)).select(*RANGES.names)
    beside, added = write_run(log, RANGES_TABLE, rows.repartition(MONTH_KEY), MONTH_KEY)
    return {beside: added}


def append_trips(
    silver: DataFrame,
    database: str,
    on_null: str = "fail",
    files: int | None = None,
    rows_per_file: int | None = None,
) -> int:
    """Append silver trips to the raw table; returns the number of rows.

    With ``files``, or ``rows_per_file`` and one more count of silver, files hold narrow
    ranges of pickup times, which are kept for ``read_slice``.
    """
    if rows_per_file is not None:
        files = files_of(silver, rows_per_file)
    return _append(TRIPS_TABLE, silver, database, on_null, files)


def append_zones(silver: DataFrame, database: str, on_null: str = "fail") -> int:
    return _append(ZONES_TABLE, silver, database, on_null)


def _append(table: str, silver: DataFrame, database: str, on_null: str, files: int | None = None) -> int:
    spark = silver.sparkSession
    log = table_log(spark, database)
    rows, counted = _counted(laid_out(table, silver, on_null, files))
    run, parts = write_run(log, table, rows, TABLES[table][1])
    mine = [part for part in parts if holds(table)(part)]
    touched = [int(part.rpartition("=")[2]) for part in mine] if table == TRIPS_TABLE else None
    ranges = write_ranges(log, run, parts) if files is not None else {}
    log.commit({run: parts} | ranges, _stale(touched))
    places = {part: [run] for part in mine}
    _add_partitions(spark, log, f"`{database}`.`{table}`", places)
    _measure(spark, database, table)
    return counted()


def _content(zones: DataFrame) -> tuple:
    """Row count and a hash of the rows, whatever their order."""
    row_hash = F.xxhash64(*zones.columns).cast("decimal(38,0)")
    return tuple(zones.agg(F.count(F.lit(1)), F.sum(row_hash)).first())


def full_refresh(
    spark: SparkSession,
    silver_trips: DataFrame,
    silver_zones: DataFrame,
    database: str,
    on_null: str = "fail",
    files: int | None = None,
    months: Iterable[int] | None = None,
    rows_per_file: int | None = None,
) -> dict[str, int]:
    """Replace both raw tables, or of the trips only ``months``. Running it again gives the
    same tables. ``files`` and ``rows_per_file`` are those of ``append_trips``.

    Both are written to new runs, and one log entry names them after both writes were
    committed: a load that fails leaves the old rows in place, and no snapshot has the
    rows of two loads.
    """
    log = table_log(spark, database)
    if rows_per_file is not None:
        files = files_of(silver_trips, rows_per_file)
    loaded, added = {}, {}
    for table, silver in ((TRIPS_TABLE, silver_trips), (ZONES_TABLE, silver_zones)):
        rows, counted = _counted(laid_out(table, silver, on_null, files))
        run, added_parts = write_run(log, table, rows, TABLES[table][1])
        added[run] = added_parts
        if table == TRIPS_TABLE and files is not None:
            added |= write_ranges(log, run, added_parts)
        loaded[table] = counted()
    before = log.latest()
    trips, zones = holds(TRIPS_TABLE, months), holds(ZONES_TABLE)
    same_zones = months is not None and _content(read_table(spark, database, ZONES_TABLE, before)) == _content(
        to_types(silver_zones, RAW_ZONES)
    )
    stale = _stale(months if same_zones else None)
    beside = [holds(name, months) for name in (rejects(TRIPS_TABLE), RANGES_TABLE)]
    old = [trips, zones, stale, *beside, holds(rejects(ZONES_TABLE))]
    after = log.commit(added, lambda part: any(of(part) for of in old))
    for table in TABLES:
        if months is None:
            register(spark, database, table, after)
        else:
            exchange(spark, database, table, before, after)
    return loaded


def write_jdbc(
    silver: DataFrame,
    schema: StructType,
    options: dict[str, str],
    refresh: bool = False,
    on_null: str = "fail",
) -> int:
    """Load a raw table of a database, by append or after truncating it; returns the
    number of rows that were sent.

    ``options`` are those of Spark's JDBC source: ``url``, ``dbtable``, ``user``,
    ``password``, ``driver``, and ``numPartitions`` to bound the connections.
    Each partition is one transaction; on a target without transactions, a task
    that runs again after a loss can leave rows twice, and a refresh repairs it.
    """
    rows, counted = _counted(to_contract(silver, schema, on_null))
    writer = rows.write.format("jdbc").options(**options)
    if refresh:
        writer = writer.mode("overwrite").option("truncate", True)
    else:
        writer = writer.mode("append")
    writer.save()
    return counted()
