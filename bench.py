"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs twice,
planning included, and the better time counts. Queries without storage are written
to Spark's noop sink, so that every row and column is computed.

``align_drifted`` aligns deliveries that are stored beforehand. ``clean_one_pass`` and ``clean_two_scans`` write silver and quarantine from the
same stored bronze objects; ``clean_five_scans`` does it the plain way, with
three counts before two writes, as something to compare the first two with.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from triplake import fixtures
from triplake.functions.trips import prepare_trips, source_month
from triplake.operators import quality
from triplake.operators.align import align, union_aligned
from triplake.queries import QUERIES
from triplake.schemas import BRONZE_TRIPS
from triplake.session import scratch_dir
from triplake.sources import bronze, lake

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2

HEADLINE = [
    "mart_revenue_by_borough",
    "int_trips_with_zones",
    "trips_silver",
    "trips_quarantine",
    "trips_rule_counts",
    "trips_row_audit",
    "trip_key",
    "silver_month_pruned",
    "raw_trips_load",
    "raw_full_refresh_twice",
    "landing_audit",
    "full_refresh_mart",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("triplake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def clean_jobs(spark: SparkSession) -> dict:
    delivered = scratch_dir(spark, "bench-bronze")
    fixtures.deliver_trips(spark, fixtures.trips_source(spark, SF_DIR), delivered)
    rules = quality.trip_rules()

    def prepared() -> DataFrame:
        return prepare_trips(bronze.read_bronze_trips(spark, f"{delivered}/*.parquet"))

    def one_pass() -> None:
        lake.write_split(prepared(), rules, scratch_dir(spark, "bench"))

    def two_scans(df: DataFrame | None = None) -> None:
        root = scratch_dir(spark, "bench")
        lake.write_separate(df or prepared(), rules, f"{root}/silver", f"{root}/quarantine")

    def five_scans() -> None:
        df = prepared()
        parts = quality.split(df, rules)
        for rows in (df, parts.clean, parts.quarantine):
            rows.count()
        two_scans(df)

    return {
        "clean_one_pass": one_pass,
        "clean_two_scans": two_scans,
        "clean_five_scans": five_scans,
    }


def drifted_jobs(spark: SparkSession) -> dict:
    """Alignment of three deliveries that were stored before the clock starts."""
    month = source_month(F.col("file_name")).alias("source_month")
    deliveries = fixtures.trips_drifted(spark, SF_DIR)
    return {"align_drifted": lambda: consume(union_aligned(align(d, BRONZE_TRIPS, month) for d in deliveries))}


def best_time(job) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = session()
    jobs = {
        name: lambda name=name: consume(QUERIES[name](spark, SF_DIR))
        for name in sys.argv[1:] or HEADLINE
    }
    if not sys.argv[1:]:
        jobs |= drifted_jobs(spark) | clean_jobs(spark)
    queries = {name: best_time(job) for name, job in jobs.items()}
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
