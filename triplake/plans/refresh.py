"""The stages of a run, and one full refresh through all of them.

Stages pass data through storage only, and none reads its own target, so a
failed run is repaired by running it again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.functions.trips import TRIP_DERIVED, prepare_trips
from triplake.operators.quality import CLEAN, VERDICT, trip_rules, zone_rules
from triplake.plans.models import build_mart, create_views
from triplake.schemas import SILVER_TRIPS, ZONES
from triplake.sources.bronze import read_bronze_trips, read_zones_csv
from triplake.sources.lake import MONTH, read_clean, write_split
from triplake.sources.landing import land
from triplake.sources.manifest import landing_log
from triplake.sources.raw import TRIPS_TABLE, create_tables, full_refresh, months_of, table_log
from triplake.sources.snapshots import GRACE_SECONDS, CommitLog


@dataclass(frozen=True)
class Lake:
    """Where a run's data lives. Any Hadoop path; credentials stay in the session."""

    bronze: str
    root: str
    database: str
    database_location: str | None = None
    trips_pattern: str = "*.parquet"
    zones_name: str = "taxi_zone_lookup.csv"

    @property
    def trips(self) -> str:
        return f"{self.root}/trips"

    @property
    def zones(self) -> str:
        return f"{self.root}/zones"


@dataclass(frozen=True)
class Policy:
    """Choices where data is missing or inexact; defaults are the usual ones."""

    null_verdict: str = "drop"
    on_null: str = "fail"
    unmatched: str = "default"
    money: str = "exact"
    gather: bool = False
    files: int | None = None
    rows_per_file: int | None = None
    # Source months to clean, load and model again; all that there are, where none are named.
    months: tuple[str, ...] | None = None
    # Versions that stay readable, and how old a run without one has to be to be removed.
    keep: int = 10
    grace_seconds: float = GRACE_SECONDS


def land_verified(
    spark: SparkSession, wanted: DataFrame, lake: Lake, force: bool = False
) -> dict[str, int]:
    """Rows by landed object; fails where bronze does not hold what was delivered."""
    landed = land(spark, wanted, lake.bronze, force).collect()
    changed = [row.object_name for row in landed if not row.verified]
    if changed:
        raise OSError(f"not as delivered, land again by force: {changed}")
    return {row.object_name: row.n_rows for row in landed}


def clean_trips(aligned: DataFrame, lake: Lake, policy: Policy = Policy()) -> dict[str, int]:
    rows = prepare_trips(aligned, keyed=False)
    return write_split(
        rows, trip_rules(), lake.trips, policy.null_verdict, policy.gather, policy.months, TRIP_DERIVED
    )


def clean_zones(zones: DataFrame, lake: Lake, policy: Policy = Policy()) -> dict[str, int]:
    return write_split(zones, zone_rules(), lake.zones, policy.null_verdict)


def load_raw(spark: SparkSession, lake: Lake, policy: Policy = Policy()) -> dict[str, int]:
    """Silver into the raw tables, which are made if absent and emptied first."""
    create_tables(spark, lake.database, lake.database_location)
    trips, months = read_clean(spark, lake.trips, SILVER_TRIPS), None
    if policy.months is not None:
        # Silver's other months stay as they are loaded; those that are not yet come along.
        parts = CommitLog(spark, lake.trips).latest().parts
        stored = {p.rpartition("=")[2] for p in parts if p.startswith(f"{VERDICT}={CLEAN}/")}
        loaded = months_of(table_log(spark, lake.database).latest(), TRIPS_TABLE)
        named = set(policy.months) | {m for m in stored if _key(m) not in loaded}
        trips = trips.filter(F.col(MONTH).isin(sorted(named)))
        months = sorted(_key(m) for m in named if _key(m) is not None)
    zones = read_clean(spark, lake.zones, ZONES)
    layout = {"files": policy.files, "rows_per_file": policy.rows_per_file}
    return full_refresh(spark, trips, zones, lake.database, policy.on_null, months=months, **layout)


def _key(month: str) -> int | None:
    """``YYYY-MM`` as raw tables write it; None for names of objects that are no months."""
    return int(month.replace("-", "")) if re.fullmatch(r"\d{4}-\d{2}", month) else None


def build_models(spark: SparkSession, lake: Lake, policy: Policy = Policy()) -> DataFrame:
    create_tables(spark, lake.database, lake.database_location)
    create_views(spark, lake.database, policy.unmatched)
    return build_mart(spark, lake.database, policy.money, policy.unmatched)


def vacuum(spark: SparkSession, lake: Lake, policy: Policy = Policy()) -> int:
    """Remove versions and runs beyond what the policy keeps; how many folders and entries."""
    logs = [CommitLog(spark, lake.trips), CommitLog(spark, lake.zones), table_log(spark, lake.database)]
    logs.append(landing_log(spark, lake.bronze))
    return sum(len(log.vacuum(policy.keep, policy.grace_seconds)) for log in logs)


def refresh(
    spark: SparkSession,
    lake: Lake,
    policy: Policy = Policy(),
    wanted: DataFrame | None = None,
    force: bool = False,
) -> dict[str, dict[str, int]]:
    """Land, clean, load and model everything; returns the row counts by stage.

    ``wanted`` names the delivered objects to land; without it bronze is used as
    it is.
    """
    audit = {}
    if wanted is not None:
        audit["landed"] = land_verified(spark, wanted, lake, force)
    trips = read_bronze_trips(spark, f"{lake.bronze}/{lake.trips_pattern}", policy.months)
    audit["trips"] = clean_trips(trips, lake, policy)
    zones = read_zones_csv(spark, f"{lake.bronze}/{lake.zones_name}")
    audit["zones"] = clean_zones(zones, lake, policy)
    audit["raw"] = load_raw(spark, lake, policy)
    build_models(spark, lake, policy)
    vacuum(spark, lake, policy)
    return audit
