"""Small trips and zones made by hand."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from triplake.schemas import BRONZE_TRIPS, ZONES

GOOD_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2023, 1, 5, 10, 0, 0),
    "tpep_dropoff_datetime": datetime(2023, 1, 5, 10, 20, 0),
    "passenger_count": 2.0,
    "trip_distance": 3.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 7,
    "DOLocationID": 8,
    "payment_type": 1,
    "fare_amount": 12.5,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 15.0,
    "congestion_surcharge": 2.5,
    "airport_fee": None,
}


def trips(spark, *changes, month="2023-01"):
    """One aligned trip for each dict of changes to a good trip."""
    values = [tuple((GOOD_TRIP | c)[n] for n in BRONZE_TRIPS.names) for c in changes]
    df = spark.createDataFrame(values, BRONZE_TRIPS)
    return df.withColumn("source_month", F.lit(month))


def zones(spark, *values):
    return spark.createDataFrame(list(values), ZONES)


def multiset(df):
    """Rows in a comparable form, whatever their order."""
    return sorted(repr(tuple(row)) for row in df.select(*sorted(df.columns)).collect())
