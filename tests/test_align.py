from datetime import datetime

import pytest
import rows
from pyspark.sql import functions as F
from triplake.operators.align import align, union_aligned
from triplake.schemas import BRONZE_TRIPS


def test_missing_column_is_typed_null(spark):
    df = align(rows.trips(spark, {}).drop("congestion_surcharge"), BRONZE_TRIPS)
    assert df.schema == BRONZE_TRIPS
    assert df.first().congestion_surcharge is None


def test_names_match_without_case(spark):
    df = rows.trips(spark, {"airport_fee": 1.25, "VendorID": 6}).withColumnsRenamed(
        {"airport_fee": "Airport_fee", "VendorID": "vendorid"}
    )
    row = align(df, BRONZE_TRIPS).first()
    assert (row.airport_fee, row.VendorID) == (1.25, 6)


def test_two_spellings_are_refused(spark):
    df = rows.trips(spark, {}).select("*", F.lit(1.0).alias("Airport_fee"))
    with pytest.raises(ValueError, match="airport_fee"):
        align(df, BRONZE_TRIPS)


def test_values_that_do_not_fit_are_null(spark):
    df = rows.trips(spark, {}).withColumns(
        {
            "trip_distance": F.lit("far"),
            "tpep_pickup_datetime": F.lit("2023-01-05 10:00:00"),
            "VendorID": F.lit(1e300),
            "fare_amount": F.lit(7),
        }
    )
    row = align(df, BRONZE_TRIPS).first()
    assert row.trip_distance is None
    assert row.VendorID is None
    assert row.tpep_pickup_datetime == datetime(2023, 1, 5, 10)
    assert row.fare_amount == 7.0


def test_undeclared_columns_go_and_order_is_declared(spark):
    df = rows.trips(spark, {}).withColumn("extra_column", F.lit(1))
    assert align(df.select(*reversed(df.columns)), BRONZE_TRIPS).columns == BRONZE_TRIPS.names


def test_union_keeps_copies(spark):
    df = align(rows.trips(spark, {}, {}), BRONZE_TRIPS)
    assert union_aligned([df, df, df]).count() == 6


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_instants_become_utc_wall_time_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        instant = spark.sql("select timestamp'2023-01-31 23:30:00 UTC' as tpep_pickup_datetime")
        row = align(instant, BRONZE_TRIPS).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.tpep_pickup_datetime == datetime(2023, 1, 31, 23, 30)
