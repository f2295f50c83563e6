"""Named queries over the given tables, one or more for each operator.

Queries that store data write to a new folder below the one the session names.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake import fixtures
from triplake.functions.trips import (
    OBJECT_PREFIX,
    OBJECT_SUFFIX,
    TRIP_DERIVED,
    month_key,
    prepare_trips,
    source_month,
)
from triplake.operators import quality
from triplake.operators.align import align
from triplake.plans import models, refresh
from triplake.schemas import BRONZE_TRIPS, RAW_TRIPS, RAW_ZONES, SILVER_TRIPS, ZONES
from triplake.session import scratch_dir
from triplake.sources import bronze, footers, lake, landing, raw

# A month in the middle of the tables' range.
PRUNED_MONTH = "1996-03"
# Days that cross the end of a month, and into how many files the table is laid out at least
# to read them.
TIME_SLICE, SLICES = (datetime(1996, 3, 20), datetime(1996, 4, 5)), 512
# Objects that are landed already.
LANDED_YEAR = "1996-"
# What a write says that is made to fail.
LOST = "lost half way"


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_trips(fixtures.trips_aligned(spark, sf_dir))


def split_trips(spark: SparkSession, sf_dir: str, null_verdict: str = "drop") -> quality.Split:
    rows = quality.split(prepared(spark, sf_dir), quality.trip_rules(), null_verdict)
    return quality.Split(*(part.drop("source_month") for part in rows))


def split_zones(spark: SparkSession, sf_dir: str) -> quality.Split:
    return quality.split(fixtures.zones_source(spark, sf_dir), quality.zone_rules())


def unkeyed(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """Prepared trips, whose key is made as they are written (``TRIP_DERIVED``)."""
    return prepare_trips(fixtures.trips_aligned(spark, sf_dir, trips), keyed=False)


def stored_trips(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> str:
    """Root of a lake folder that holds the judged trips."""
    root = scratch_dir(spark, "trips")
    rows, rules = unkeyed(spark, sf_dir, trips), quality.trip_rules()
    lake.write_split(rows, rules, root, gather=True, derived=TRIP_DERIVED)
    return root


def stored_zones(spark: SparkSession, sf_dir: str) -> str:
    """Root of a lake folder that holds the zones as judged after a CSV delivery."""
    root = scratch_dir(spark, "zones")
    lake.write_split(q_zones_csv(spark, sf_dir), quality.zone_rules(), root)
    return root


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """Names and paths of what was delivered to ``folder``."""
    objects = bronze.glob_objects(spark, f"{folder}/*{OBJECT_SUFFIX}")
    rows = [(o.name, o.path) for o in objects]
    return spark.createDataFrame(rows, f"{landing.NAME} string, {landing.SOURCE} string")


def raw_database(spark: SparkSession) -> str:
    """A new database with empty raw tables."""
    location = scratch_dir(spark, "raw")
    database = location.rsplit("/", 1)[-1].replace("-", "_")
    raw.create_tables(spark, database, location)
    return database


# --- alignment and derived columns -------------------------------------------


def q_source_month(spark, sf_dir):
    name = F.col("file_name")
    return (
        fixtures.trips_source(spark, sf_dir)
        .groupBy("file_name", source_month(name).alias("source_month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def q_align_zoned(spark, sf_dir):
    month = source_month(F.col("file_name")).alias("source_month")
    return align(fixtures.trips_zoned(spark, sf_dir), BRONZE_TRIPS, month)


def q_union_months(spark, sf_dir):
    rows = fixtures.trips_union(spark, sf_dir)
    return rows.groupBy("source_month").agg(F.count(F.lit(1)).alias("n"))


def q_narrow_types(spark, sf_dir):
    columns = ["VendorID", "passenger_count", "RatecodeID", "payment_type"]
    return prepared(spark, sf_dir).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def q_trip_key(spark, sf_dir):
    return prepared(spark, sf_dir).select("trip_id", "VendorID", "total_amount")


def q_partition_month(spark, sf_dir):
    return prepared(spark, sf_dir).groupBy("partition_month").agg(F.count(F.lit(1)).alias("n"))


# --- quality -----------------------------------------------------------------


def q_trips_rule_counts(spark, sf_dir):
    return quality.rule_counts(prepared(spark, sf_dir), quality.trip_rules())


def q_trips_row_audit(spark, sf_dir):
    judged = quality.judge(prepared(spark, sf_dir), quality.trip_rules())
    return judged.agg(*quality.audit_columns(F.col(quality.VERDICT)))


def q_split_audit_stored(spark, sf_dir):
    """The counts that the writing tasks give."""
    root = scratch_dir(spark, "audit")
    rows, rules = unkeyed(spark, sf_dir), quality.trip_rules()
    counts = lake.write_split(rows, rules, root, gather=True, derived=TRIP_DERIVED)
    names = ("n_read", "n_clean", "n_quarantined", "n_unjudged")
    schema = ", ".join(f"{name} long" for name in names)
    return spark.createDataFrame([tuple(counts[name] for name in names)], schema)


def q_zones_row_audit(spark, sf_dir):
    judged = quality.judge(fixtures.zones_source(spark, sf_dir), quality.zone_rules())
    counts = judged.agg(*quality.audit_columns(F.col(quality.VERDICT)))
    return counts.drop("n_unjudged")


# --- storage -----------------------------------------------------------------


def q_silver_month_pruned(spark, sf_dir):
    silver = lake.read_clean(spark, stored_trips(spark, sf_dir), SILVER_TRIPS)
    return silver.filter(F.col("partition_month") == PRUNED_MONTH)


def q_silver_snapshot_read(spark, sf_dir):
    """Silver as it was before a write that was lost after most of its rows."""
    trips = fixtures.trips_stored(spark, sf_dir)
    root, rules = stored_trips(spark, sf_dir, trips), quality.trip_rules()
    late = F.col("VendorID") == 7
    dies = F.when(late, F.raise_error(F.lit(LOST)).cast("double")).otherwise(F.col("extra"))
    rows = unkeyed(spark, sf_dir, trips).withColumn("extra", dies)
    try:
        lake.write_split(rows, rules, root, gather=True, derived=TRIP_DERIVED)
    except PySparkException as error:
        if LOST not in str(error):
            raise
    else:
        raise RuntimeError("the write should have failed")
    return lake.read_clean(spark, root, SILVER_TRIPS)


def q_silver_month_rewritten(spark, sf_dir):
    """All months stored, then one of them again from a smaller delivery."""
    trips = fixtures.trips_stored(spark, sf_dir)
    root, rules = stored_trips(spark, sf_dir, trips), quality.trip_rules()
    fewer = unkeyed(spark, sf_dir, trips).filter(F.col("VendorID") <= 3)
    lake.write_split(fewer, rules, root, gather=True, months=[PRUNED_MONTH], derived=TRIP_DERIVED)
    parts = {
        quality.CLEAN: lake.read_clean(spark, root, SILVER_TRIPS),
        quality.QUARANTINE: lake.read_quarantine(spark, root, SILVER_TRIPS),
    }
    clean, rejected = (rows.withColumn("verdict", F.lit(name)) for name, rows in parts.items())
    return clean.unionByName(rejected)


def q_quarantine_stored(spark, sf_dir):
    return lake.read_quarantine(spark, stored_trips(spark, sf_dir), SILVER_TRIPS)


def q_split_stored_apart(spark, sf_dir):
    """Both outputs as datasets of their own, counted by month."""
    root = scratch_dir(spark, "apart")
    paths = f"{root}/silver", f"{root}/quarantine"
    rows, rules = unkeyed(spark, sf_dir), quality.trip_rules()
    lake.write_separate(rows, rules, *paths, gather=True, derived=TRIP_DERIVED)
    counts = [
        lake.read_dataset(spark, path, SILVER_TRIPS)
        .groupBy("partition_month")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(verdict).alias("verdict"), "partition_month", "n")
        for verdict, path in zip((quality.CLEAN, quality.QUARANTINE), paths)
    ]
    return counts[0].unionByName(counts[1])


def q_bronze_drifted(spark, sf_dir):
    """Three deliveries with schemas of their own, read back as one frame."""
    root = scratch_dir(spark, "bronze")
    for i, trips in enumerate(fixtures.trips_drifted(spark, sf_dir)):
        fixtures.deliver_trips(spark, trips, f"{root}/{i}")
    return bronze.read_bronze_trips(spark, f"{root}/*/*.parquet")


def q_bronze_mixed_parts(spark, sf_dir):
    """Objects whose parts differ in their columns, landed and read back."""
    root = scratch_dir(spark, "mixed")
    trips = fixtures.trips_source(spark, sf_dir)
    early = F.col("VendorID") < 4
    parts = trips.filter(early).drop("airport_fee"), trips.filter(~early)
    fixtures.deliver_trips(spark, parts[0], f"{root}/source", parts[1])
    landing.land(spark, delivered(spark, f"{root}/source"), f"{root}/bronze")
    return bronze.read_bronze_trips(spark, f"{root}/bronze/*.parquet")


def q_zones_csv(spark, sf_dir):
    root, name = scratch_dir(spark, "zones-csv"), "taxi_zone_lookup.csv"
    fixtures.deliver_zones(fixtures.zones_source(spark, sf_dir), f"{root}/source/{name}")
    wanted = landing.monthly_objects(spark, f"{root}/source", [], [name])
    landing.land(spark, wanted, f"{root}/bronze")
    return bronze.read_zones_csv(spark, f"{root}/bronze/{name}")


def q_zones_csv_rejects(spark, sf_dir):
    """Lines of a delivered lookup that do not fit it, and why."""
    folder = scratch_dir(spark, "zone-lines")
    fixtures.deliver_zone_lines(fixtures.zone_lines(spark, sf_dir), folder)
    return bronze.zones_csv_rejects(spark, folder)


def q_zones_stored(spark, sf_dir):
    """Both zone outputs, read back from storage."""
    root = stored_zones(spark, sf_dir)
    clean = lake.read_clean(spark, root, ZONES)
    rejected = lake.read_quarantine(spark, root, ZONES)
    return clean.withColumn("verdict", F.lit(quality.CLEAN)).unionByName(
        rejected.withColumn("verdict", F.lit(quality.QUARANTINE))
    )


def q_landing_missing(spark, sf_dir):
    """What is still to be landed after one year was."""
    root = scratch_dir(spark, "missing")
    trips = fixtures.trips_source(spark, sf_dir)
    year = F.contains("file_name", F.lit(LANDED_YEAR))
    fixtures.deliver_trips(spark, trips.filter(year), f"{root}/source")
    landing.land(spark, delivered(spark, f"{root}/source"), f"{root}/bronze")
    wanted = trips.select(F.col("file_name").alias(landing.NAME)).distinct()
    missing = landing.missing_objects(wanted, landing.landed_objects(spark, f"{root}/bronze"))
    return missing.withColumnRenamed(landing.NAME, "file_name")


def q_landing_audit(spark, sf_dir):
    """Every delivered month landed in an empty bronze."""
    root = scratch_dir(spark, "landing")
    fixtures.deliver_trips(spark, fixtures.trips_source(spark, sf_dir), f"{root}/source")
    landing.land(spark, delivered(spark, f"{root}/source"), f"{root}/bronze")
    audit = landing.kept_audit(spark, f"{root}/bronze")
    return audit.select(landing.NAME, "n_rows", "verified")


def q_bronze_schema_groups(spark, sf_dir):
    """Which objects of three drifted deliveries have the same columns, by their footers."""
    root = scratch_dir(spark, "groups")
    for i, trips in enumerate(fixtures.trips_drifted(spark, sf_dir)):
        fixtures.deliver_trips(spark, trips, f"{root}/{i}")
    groups = bronze.schema_groups(spark, bronze.glob_objects(spark, f"{root}/*/*{OBJECT_SUFFIX}"))
    rows = groups.select(
        F.array_join("columns", ",").alias("columns"), "n_rows", F.explode("objects").alias(landing.NAME)
    )
    return rows


def q_landing_committed(spark, sf_dir):
    """What is in bronze after one year was landed, and a landing of all was lost between
    its rows and its entry in the log."""
    root = scratch_dir(spark, "committed")
    trips = fixtures.trips_source(spark, sf_dir)
    fixtures.deliver_trips(spark, trips, f"{root}/source")
    wanted = delivered(spark, f"{root}/source")
    year = F.contains(landing.NAME, F.lit(LANDED_YEAR))
    landing.land(spark, wanted.filter(year), f"{root}/bronze")
    for group in bronze.group_objects(spark, bronze.glob_objects(spark, f"{root}/source/*{OBJECT_SUFFIX}")):
        landing.write_group(spark, group, f"{root}/bronze")
    rows = bronze.read_bronze_trips(spark, f"{root}/bronze/*{OBJECT_SUFFIX}")
    return rows.groupBy("source_month").agg(F.count(F.lit(1)).alias("n"))


def q_landing_digests(spark, sf_dir):
    """Size and digest of every text object as it was delivered, read range by range."""
    folder = scratch_dir(spark, "digests")
    fixtures.deliver_lines(fixtures.trip_lines(spark, sf_dir), folder)
    objects = bronze.glob_objects(spark, f"{folder}/file_name=*")
    digests = footers.file_digests(spark, objects, range_bytes=1 << 14, block=1 << 12, fan=4)
    names = spark.createDataFrame(
        [(i, o.name.removeprefix("file_name=")) for i, o in enumerate(objects)], "object int, file_name string"
    )
    return digests.join(names, "object").select("file_name", "n_bytes", "digest")


# --- raw tables --------------------------------------------------------------


def q_raw_trips_load(spark, sf_dir, ranged=False):
    database = raw_database(spark)
    files = int(spark.conf.get("spark.sql.shuffle.partitions")) if ranged else None
    silver = lake.read_clean(spark, stored_trips(spark, sf_dir), SILVER_TRIPS)
    raw.append_trips(silver, database, files=files)
    return spark.table(f"{database}.{raw.TRIPS_TABLE}").select(*RAW_TRIPS.names)


def q_raw_time_slice(spark, sf_dir):
    """Some days of trips, from a table whose files hold narrow time ranges: of its files
    only those that hold rows of these days are read."""
    database = raw_database(spark)
    silver = lake.read_clean(spark, stored_trips(spark, sf_dir), SILVER_TRIPS)
    rows_per_file = min(raw.ROWS_PER_FILE, silver.count() // SLICES + 1)
    raw.append_trips(silver, database, rows_per_file=rows_per_file)
    return raw.read_slice(spark, database, *TIME_SLICE).select(*RAW_TRIPS.names)


def q_raw_month_key(spark, sf_dir):
    silver = split_trips(spark, sf_dir).clean
    return silver.groupBy(month_key().alias("month_key")).agg(F.count(F.lit(1)).alias("n"))


def q_raw_zones_load(spark, sf_dir):
    database = raw_database(spark)
    silver = lake.read_clean(spark, stored_zones(spark, sf_dir), ZONES)
    raw.append_zones(silver, database)
    return spark.table(f"{database}.{raw.ZONES_TABLE}").select(*RAW_ZONES.names)


def q_raw_append_twice(spark, sf_dir):
    database = raw_database(spark)
    silver = lake.read_clean(spark, stored_trips(spark, sf_dir), SILVER_TRIPS)
    for _ in range(2):
        raw.append_trips(silver, database)
    return spark.table(f"{database}.{raw.TRIPS_TABLE}").select(*RAW_TRIPS.names)


def q_raw_load_defaults(spark, sf_dir):
    """All trips, faulty ones as well, in a table that takes no NULL."""
    database = raw_database(spark)
    trips = lake.gathered(prepared(spark, sf_dir).drop("source_month"), "partition_month")
    raw.append_trips(trips, database, on_null="default")
    return spark.table(f"{database}.{raw.TRIPS_TABLE}").select(*RAW_TRIPS.names)


def q_raw_load_rejects(spark, sf_dir):
    """All trips loaded, and what the NOT NULL rule kept out, by the columns it broke."""
    database = raw_database(spark)
    trips = lake.gathered(prepared(spark, sf_dir).drop("source_month"), "partition_month")
    loaded = raw.append_trips(trips, database, on_null="reject")
    broken = raw.read_rejects(spark, database, raw.TRIPS_TABLE)
    counts = broken.groupBy(F.col(raw.BROKEN).alias("broken")).agg(F.count(F.lit(1)).alias("n"))
    kept = raw.read_table(spark, database, raw.TRIPS_TABLE).agg(F.count(F.lit(1)).alias("n"))
    if kept.first().n != loaded:
        raise RuntimeError("the load counted other rows than it stored")
    return counts.unionByName(kept.select(F.lit(0).cast("long").alias("broken"), "n"))


def q_loaded_counts(spark, sf_dir):
    database = raw_database(spark)
    trips = lake.read_clean(spark, stored_trips(spark, sf_dir), SILVER_TRIPS)
    zones = lake.read_clean(spark, stored_zones(spark, sf_dir), ZONES)
    counts = raw.full_refresh(spark, trips, zones, database)
    return spark.createDataFrame(list(counts.items()), "table_name string, n long")


def q_raw_full_refresh_twice(spark, sf_dir):
    database = raw_database(spark)
    trips = lake.read_clean(spark, stored_trips(spark, sf_dir), SILVER_TRIPS)
    zones = lake.read_clean(spark, stored_zones(spark, sf_dir), ZONES)
    for _ in range(2):
        raw.full_refresh(spark, trips, zones, database)
    return spark.table(f"{database}.{raw.TRIPS_TABLE}").select(*RAW_TRIPS.names)


# --- models ------------------------------------------------------------------


def q_stg_trips(spark, sf_dir):
    return models.stg_trips(raw.to_types(split_trips(spark, sf_dir).clean, RAW_TRIPS))


def q_stg_zones(spark, sf_dir):
    return models.stg_zones(raw.to_types(split_zones(spark, sf_dir).clean, RAW_ZONES))


def q_int_trips_with_zones(spark, sf_dir, unmatched="default"):
    trips, zones = q_stg_trips(spark, sf_dir), q_stg_zones(spark, sf_dir)
    return models.int_trips_with_zones(trips, zones, unmatched)


def q_int_trips_skewed(spark, sf_dir):
    """The enriched trips with a lookup that counts as too large to broadcast."""
    trips, zones = q_stg_trips(spark, sf_dir), q_stg_zones(spark, sf_dir)
    return models.int_trips_with_zones(trips, zones, max_rows=0)


def q_mart_revenue_by_borough(spark, sf_dir, unmatched="default"):
    """The whole path from source tables to the mart as a single plan."""
    enriched = q_int_trips_with_zones(spark, sf_dir, unmatched)
    return models.mart_revenue_by_borough(enriched, money="decimal")


def q_mart_revenue_exact(spark, sf_dir):
    """The mart over trips in another order and number of tasks: the sum of the doubles,
    rounded once."""
    rows = q_int_trips_with_zones(spark, sf_dir).repartition(13)
    return models.mart_revenue_by_borough(rows)


def new_lake(spark: SparkSession) -> refresh.Lake:
    root = scratch_dir(spark, "refresh")
    return refresh.Lake(
        bronze=f"{root}/bronze",
        root=f"{root}/lake",
        database=root.rsplit("/", 1)[-1].replace("-", "_"),
        database_location=f"{root}/warehouse",
    )


def deliver_all(spark: SparkSession, sf_dir: str, place: refresh.Lake, trips: DataFrame) -> None:
    fixtures.deliver_trips(spark, trips, place.bronze)
    zones = fixtures.zones_source(spark, sf_dir)
    fixtures.deliver_zones(zones, f"{place.bronze}/{place.zones_name}")


def q_refresh_one_month(spark, sf_dir):
    """All months through to the mart; then one month's object comes again with fewer
    trips, and only that month is cleaned, loaded and added up anew."""
    place = new_lake(spark)
    trips = fixtures.trips_source(spark, sf_dir)
    deliver_all(spark, sf_dir, place, trips)
    refresh.refresh(spark, place)
    name = f"{OBJECT_PREFIX}{PRUNED_MONTH}{OBJECT_SUFFIX}"
    fixtures.deliver_again(spark, place.bronze, name, trips.schema, F.col("VendorID") <= 3)
    refresh.refresh(spark, place, refresh.Policy(months=(PRUNED_MONTH,)))
    return spark.table(f"{place.database}.{models.REVENUE_MART}")


def q_full_refresh_mart(spark, sf_dir, again=False):
    """The same path through storage: bronze, silver, raw tables, views and mart.

    ``again``: once more after the catalog has lost its entries, as in a new session.
    """
    place = new_lake(spark)
    deliver_all(spark, sf_dir, place, fixtures.trips_source(spark, sf_dir))
    policy = refresh.Policy(money="decimal")
    refresh.refresh(spark, place, policy)
    if again:
        for kind, name in (
            ("VIEW", models.TRIPS_WITH_ZONES),
            ("VIEW", models.STG_TRIPS),
            ("VIEW", models.STG_ZONES),
            ("TABLE", models.REVENUE_MART),
            ("TABLE", raw.TRIPS_TABLE),
            ("TABLE", raw.ZONES_TABLE),
        ):
            spark.sql(f"DROP {kind} `{place.database}`.`{name}`")
        # The models find what was loaded before; then all is done once more.
        refresh.build_models(spark, place, policy)
        refresh.refresh(spark, place, policy)
    return spark.table(f"{place.database}.{models.REVENUE_MART}")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_month": q_source_month,
    "align_schema": fixtures.trips_aligned,
    "align_drifted": fixtures.trips_union,
    "align_zoned": q_align_zoned,
    "bronze_drifted": q_bronze_drifted,
    "bronze_mixed_parts": q_bronze_mixed_parts,
    "union_months": q_union_months,
    "narrow_types": q_narrow_types,
    "trip_key": q_trip_key,
    "partition_month": q_partition_month,
    "trips_silver": lambda spark, sf_dir: split_trips(spark, sf_dir).clean,
    "trips_quarantine": lambda spark, sf_dir: split_trips(spark, sf_dir).quarantine,
    "trips_quarantine_all": lambda spark, sf_dir: split_trips(spark, sf_dir, "quarantine").quarantine,
    "trips_unjudged": lambda spark, sf_dir: split_trips(spark, sf_dir).unjudged,
    "trips_rule_counts": q_trips_rule_counts,
    "trips_row_audit": q_trips_row_audit,
    "split_audit_stored": q_split_audit_stored,
    "silver_month_pruned": q_silver_month_pruned,
    "silver_month_rewritten": q_silver_month_rewritten,
    "silver_snapshot_read": q_silver_snapshot_read,
    "quarantine_stored": q_quarantine_stored,
    "split_stored_apart": q_split_stored_apart,
    "zones_csv": q_zones_csv,
    "zones_silver": lambda spark, sf_dir: split_zones(spark, sf_dir).clean,
    "zones_quarantine": lambda spark, sf_dir: split_zones(spark, sf_dir).quarantine,
    "zones_stored": q_zones_stored,
    "zones_csv_rejects": q_zones_csv_rejects,
    "zones_row_audit": q_zones_row_audit,
    "raw_month_key": q_raw_month_key,
    "raw_trips_load": q_raw_trips_load,
    "raw_trips_load_ranged": partial(q_raw_trips_load, ranged=True),
    "raw_time_slice": q_raw_time_slice,
    "raw_zones_load": q_raw_zones_load,
    "raw_append_twice": q_raw_append_twice,
    "raw_load_defaults": q_raw_load_defaults,
    "raw_load_rejects": q_raw_load_rejects,
    "loaded_counts": q_loaded_counts,
    "raw_full_refresh_twice": q_raw_full_refresh_twice,
    "landing_missing": q_landing_missing,
    "landing_audit": q_landing_audit,
    "landing_committed": q_landing_committed,
    "landing_digests": q_landing_digests,
    "bronze_schema_groups": q_bronze_schema_groups,
    "stg_trips": q_stg_trips,
    "stg_zones": q_stg_zones,
    "int_trips_with_zones": q_int_trips_with_zones,
    "int_trips_with_zones_nulls": partial(q_int_trips_with_zones, unmatched="null"),
    "int_trips_skewed": q_int_trips_skewed,
    "mart_revenue_by_borough": q_mart_revenue_by_borough,
    "mart_revenue_by_borough_nulls": partial(q_mart_revenue_by_borough, unmatched="null"),
    "mart_revenue_exact": q_mart_revenue_exact,
    "full_refresh_mart": q_full_refresh_mart,
    "refresh_one_month": q_refresh_one_month,
    "refresh_registered_again": partial(q_full_refresh_mart, again=True),
}
