"""Staging, intermediate and mart models.

Each model is a function over DataFrames. The staging and intermediate models
can also be kept as catalog views, built from the same column lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from triplake.functions.exact import exact_sums, partial_sums
from triplake.functions.trips import month_key
from triplake.operators.joins import frequent_keys, spread_left_join
from triplake.schemas import RAW_TRIPS, RAW_ZONES, STAGING_TRIP_NAMES, STAGING_ZONE_NAMES
from triplake.sources.raw import (
    DERIVED,
    MONTH_KEY,
    TRIPS_TABLE,
    ZONES_TABLE,
    holds,
    months_of,
    read_table,
    table_log,
    write_run,
)
from triplake.sources.snapshots import CommitLog, Snapshot

STG_TRIPS, STG_ZONES = "stg_trips", "stg_zones"
TRIPS_WITH_ZONES = "int_trips_with_zones"
REVENUE_MART = "mart_revenue_by_borough"

# What an unmatched zone gives: the text type's default, or NULL.
UNMATCHED = ("default", "null")

# A lookup within these bounds is broadcast; a larger one is left to Catalyst.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Negative where the session forbids broadcasts.
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"

# How revenue is added: to the nearest double whatever the order, as cents, or plainly.
MONEY = ("exact", "decimal", "double")

ZONE_ATTRIBUTES = ("borough", "zone", "service_zone")


def _renamed(names: list[str], renames: dict[str, str]) -> list[str]:
    return [f"{n} AS {renames[n]}" if n in renames else n for n in names]


STAGED_TRIPS = _renamed(RAW_TRIPS.names, STAGING_TRIP_NAMES)
STAGED_ZONES = _renamed(RAW_ZONES.names, STAGING_ZONE_NAMES)


def enriched_columns(unmatched: str = "default") -> list[str]:
    """Trip columns, each location id followed by what its zone is."""
    if unmatched not in UNMATCHED:
        raise ValueError(f"unmatched must be one of {UNMATCHED}: {unmatched}")
    columns = []
    for raw_name in RAW_TRIPS.names:
        name = STAGING_TRIP_NAMES.get(raw_name, raw_name)
        columns.append(f"trip.{name}")
        role = name.removesuffix("_location_id")
        if role == name:
            continue
        for attribute in ZONE_ATTRIBUTES:
            value = f"{role}.{attribute}"
            if unmatched == "default":
                value = f"coalesce({value}, '')"
            columns.append(f"{value} AS {role}_{attribute}")
    return columns


def stg_trips(raw_trips: DataFrame) -> DataFrame:
    return raw_trips.selectExpr(*STAGED_TRIPS)


def stg_zones(raw_zones: DataFrame) -> DataFrame:
    return raw_zones.selectExpr(*STAGED_ZONES)


def lookup_side(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` marked for broadcast if it is measured to be small, else unchanged.

    A session that forbids broadcasts is obeyed. The measuring job reads ``max_rows + 1``
    rows at most.
    """
    if df.sparkSession.conf.get(THRESHOLD).startswith("-"):
        return df
    width = F.lit(0)
    for field in df.schema:
        text = isinstance(field.dataType, (StringType, StructType))
        size = F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0)) + 16 if text else F.lit(8)
        width = width + size
    size = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(width).alias("n_bytes")
    )
    n_rows, n_bytes = size.first()
    if n_rows <= max_rows and (n_bytes or 0) <= max_bytes:
        return F.broadcast(df)
    return df


def int_trips_with_zones(
    trips: DataFrame, zones: DataFrame, unmatched: str = "default", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Trips with the zone of both ends. Every trip stays; a zone id that occurs
    more than once gives that many rows. A lookup of more than ``max_rows`` is joined by
    shuffle, with the rows of frequent zones left where they are."""
    lookup = lookup_side(zones, max_rows)
    if lookup is zones:
        return _joined_by_shuffle(trips, zones).selectExpr(*(c.replace("trip.", "") for c in enriched_columns(unmatched)))
    joined = trips.alias("trip")
    for role in ("pickup", "dropoff"):
        matches = F.col(f"trip.{role}_location_id") == F.col(f"{role}.location_id")
        joined = joined.join(lookup.alias(role), matches, "left")
    return joined.selectExpr(*enriched_columns(unmatched))


def _joined_by_shuffle(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with a struct of each role's zone."""
    joined = trips
    for role in ("pickup", "dropoff"):
        attributes = F.struct(*ZONE_ATTRIBUTES).alias(role)
        lookup = zones.select(F.col("location_id").alias(f"_{role}_id"), attributes)
        key = f"{role}_location_id"
        frequent = frequent_keys(trips, F.col(key))
        joined = spread_left_join(joined, lookup, key, f"_{role}_id", lookup_side, frequent).drop(f"_{role}_id")
    return joined


def revenue_parts(enriched: DataFrame, *keys: str) -> DataFrame:
    """What the mart's exact totals are put together from; parts of several months or
    loads can be merged later."""
    rows = enriched.select(F.col("pickup_borough").alias("borough"), *keys, "total_amount")
    return partial_sums(rows, ["borough", *keys], "total_amount")


def total(amount: str, money: str) -> Column:
    """Sum of an amount by another way than the exact one. A plain sum of doubles depends
    on row order in its last digits; ``decimal`` adds whole cents, for amounts of up to 16
    digits and no NaN."""
    if money == "decimal":
        return F.sum(F.col(amount).cast("decimal(18,2)")).cast("double")
    if money == "double":
        return F.sum(amount)
    raise ValueError(f"money must be one of {MONEY}: {money}")


def mart_revenue_by_borough(enriched: DataFrame, money: str = "exact") -> DataFrame:
    """Trips and revenue by pickup borough. Map tasks aggregate first, so a shuffle
    carries one row per borough and task, however many trips a borough has."""
    if money == "exact":
        return exact_sums(revenue_parts(enriched), ["borough"], "trip_count", "total_revenue")
    return enriched.groupBy(F.col("pickup_borough").alias("borough")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        total("total_amount", money).alias("total_revenue"),
    )


def create_views(spark: SparkSession, database: str, unmatched: str = "default") -> None:
    """Staging and intermediate models as catalog views over the raw tables."""
    at = f"`{database}`"
    joins = " ".join(
        f"LEFT JOIN {at}.{STG_ZONES} AS {role}"
        f" ON trip.{role}_location_id = {role}.location_id"
        for role in ("pickup", "dropoff")
    )
    bodies = {
        STG_TRIPS: (STAGED_TRIPS, f"{at}.{TRIPS_TABLE}"),
        STG_ZONES: (STAGED_ZONES, f"{at}.{ZONES_TABLE}"),
        TRIPS_WITH_ZONES: (enriched_columns(unmatched), f"{at}.{STG_TRIPS} AS trip {joins}"),
    }
    for name, (columns, source) in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE VIEW {at}.{name} AS SELECT {', '.join(columns)} FROM {source}"
        )


def mart_parts(unmatched: str = "default") -> str:
    """Table of the parts by month that the mart's exact totals are put together from."""
    return f"{REVENUE_MART}{DERIVED}{unmatched}"


def _enriched(spark: SparkSession, database: str, snapshot: Snapshot, unmatched: str, months=None) -> DataFrame:
    """The intermediate model over both raw tables of one snapshot."""
    raw_trips = read_table(spark, database, TRIPS_TABLE, snapshot)
    if months is not None:
        raw_trips = raw_trips.filter(F.col(MONTH_KEY).isin(sorted(months)))
    zones = stg_zones(read_table(spark, database, ZONES_TABLE, snapshot))
    return int_trips_with_zones(stg_trips(raw_trips), zones, unmatched)


def build_mart(
    spark: SparkSession, database: str, money: str = "exact", unmatched: str = "default"
) -> DataFrame:
    """Rebuild the mart table from one snapshot of the raw tables.

    Exact totals are kept as parts by month, which loads take out where they change what
    a part was made from. Only trips of months without a part are read.
    """
    log = table_log(spark, database)
    snapshot = log.latest()
    if money == "exact":
        totals, added, replaced = _exact_totals(spark, database, log, snapshot, unmatched)
    else:
        totals = mart_revenue_by_borough(_enriched(spark, database, snapshot, unmatched), money)
        added, replaced = {}, set()
    run, parts = write_run(log, REVENUE_MART, totals, None)
    mart = holds(REVENUE_MART)
    log.commit(added | {run: parts}, lambda part: mart(part) or part in replaced)
    # A new folder each time: readers of the old content are not cut off, and a
    # failing build leaves it in place.
    name = f"`{database}`.`{REVENUE_MART}`"
    path = f"{log.path(run)}/{parts[0]}".replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def _exact_totals(
    spark: SparkSession, database: str, log: CommitLog, snapshot: Snapshot, unmatched: str
) -> tuple[DataFrame, dict[str, list[str]], set[str]]:
    """Totals from the parts of all months; parts that were made for them, by run; parts
    of months that are gone."""
    stored = mart_parts(unmatched)
    there, needed = months_of(snapshot, stored), months_of(snapshot, TRIPS_TABLE)
    missing = needed - there
    held = {p: runs for p, runs in snapshot.parts.items() if holds(stored, needed)(p)}
    gone = {p for p in snapshot.parts if holds(stored)(p)} - held.keys()
    enriched = _enriched(spark, database, snapshot, unmatched, missing if there & needed else None)
    fresh = revenue_parts(enriched.withColumn(MONTH_KEY, month_key("pickup_datetime")), MONTH_KEY)
    added, written = {}, dict(snapshot.written)
    if missing:
        run, parts = write_run(log, stored, fresh, MONTH_KEY)
        added, written[run] = {run: parts}, len(parts)
        held |= {part: [run] for part in parts}
    fields = [f for f in fresh.schema if f.name != MONTH_KEY]
    schema = StructType([*fields, StructField(MONTH_KEY, LongType())])
    rows = log.read(schema, Snapshot(snapshot.version, held, written))
    return exact_sums(rows, ["borough"], "trip_count", "total_revenue"), added, gone
