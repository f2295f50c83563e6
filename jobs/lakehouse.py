"""Run one stage, or all of them, with spark-submit.

    spark-submit --py-files triplake.zip jobs/lakehouse.py refresh \\
        --bronze s3a://bronze --root s3a://lake --database lakehouse

The session takes master, storage keys and sizes from its own configuration. The
JDBC password is read from ``spark.triplake.jdbc.password``, never from the
command line.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from triplake.operators.quality import NULL_VERDICTS
from triplake.plans import refresh as stages
from triplake.plans.models import MONEY, UNMATCHED
from triplake.schemas import RAW_TRIPS, RAW_ZONES, SILVER_TRIPS, ZONES
from triplake.sources.bronze import read_bronze_trips, read_zones_csv
from triplake.sources.lake import read_clean
from triplake.sources.landing import monthly_objects
from triplake.sources.raw import ON_NULL, write_jdbc

JDBC_PASSWORD = "spark.triplake.jdbc.password"


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--bronze", required=True, help="folder of delivered objects")
    parser.add_argument("--root", required=True, help="folder of silver and quarantine")
    parser.add_argument("--database", default="lakehouse")
    parser.add_argument("--database-location", help="folder of the database's tables")
    parser.add_argument("--source", help="folder to land objects from")
    parser.add_argument("--months", help="months to land, as 2023-01,2023-02")
    parser.add_argument("--only-months", help="months to clean again, the others stay")
    parser.add_argument("--force", action="store_true", help="land what is there as well")
    parser.add_argument("--null-verdict", choices=NULL_VERDICTS, default="drop")
    parser.add_argument("--on-null", choices=ON_NULL, default="fail")
    parser.add_argument("--unmatched", choices=UNMATCHED, default="default")
    parser.add_argument("--money", choices=MONEY, default="exact")
    parser.add_argument("--gather", action="store_true", help="shuffle silver by month")
    parser.add_argument("--files", type=int, help="split the raw trips into key ranges")
    parser.add_argument("--rows-per-file", type=int, help="split them into ranges of that many rows")
    parser.add_argument("--truncate", action="store_true", help="empty JDBC tables first")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    return parser.parse_args(argv)


def wanted_objects(spark, args, lake) -> DataFrame | None:
    if not (args.source and args.months):
        return None
    return monthly_objects(spark, args.source, args.months.split(","), [lake.zones_name])


def stage_land(spark, args, lake, policy):
    wanted = wanted_objects(spark, args, lake)
    if wanted is None:
        raise SystemExit("land needs --source and --months")
    return stages.land_verified(spark, wanted, lake, args.force)


def stage_clean_trips(spark, args, lake, policy):
    trips = read_bronze_trips(spark, f"{lake.bronze}/{lake.trips_pattern}", policy.months)
    return stages.clean_trips(trips, lake, policy)


def stage_clean_zones(spark, args, lake, policy):
    zones = read_zones_csv(spark, f"{lake.bronze}/{lake.zones_name}")
    return stages.clean_zones(zones, lake, policy)


def stage_load_raw(spark, args, lake, policy):
    return stages.load_raw(spark, lake, policy)


def stage_load_jdbc(spark, args, lake, policy):
    options = dict(pair.split("=", 1) for pair in args.jdbc_option)
    password = spark.conf.get(JDBC_PASSWORD, None)
    if password is not None:
        options["password"] = password
    loads = (
        ("raw_trips", read_clean(spark, lake.trips, SILVER_TRIPS), RAW_TRIPS),
        ("raw_zones", read_clean(spark, lake.zones, ZONES), RAW_ZONES),
    )
    for table, silver, schema in loads:
        target = options | {"dbtable": table}
        write_jdbc(silver, schema, target, args.truncate, policy.on_null)
    return {"loaded": [table for table, _, _ in loads]}


def stage_models(spark, args, lake, policy):
    return {"boroughs": stages.build_models(spark, lake, policy).count()}


def stage_refresh(spark, args, lake, policy):
    wanted = wanted_objects(spark, args, lake)
    return stages.refresh(spark, lake, policy, wanted, args.force)


STAGES = {
    "land": stage_land,
    "clean-trips": stage_clean_trips,
    "clean-zones": stage_clean_zones,
    "load-raw": stage_load_raw,
    "load-jdbc": stage_load_jdbc,
    "models": stage_models,
    "refresh": stage_refresh,
}


def run(spark: SparkSession, argv: list[str] | None = None) -> dict:
    args = parse(argv)
    lake = stages.Lake(args.bronze, args.root, args.database, args.database_location)
    policy = stages.Policy(
        null_verdict=args.null_verdict,
        on_null=args.on_null,
        unmatched=args.unmatched,
        money=args.money,
        gather=args.gather,
        files=args.files,
        rows_per_file=args.rows_per_file,
        months=tuple(args.only_months.split(",")) if args.only_months else None,
    )
    return STAGES[args.stage](spark, args, lake, policy)


if __name__ == "__main__":
    session = SparkSession.builder.appName("triplake").getOrCreate()
    print(json.dumps(run(session)))
    session.stop()
