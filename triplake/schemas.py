"""Declared schemas, load contracts and model column lists.

Column names and types are fixed values: files, tables and queries downstream
depend on them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Timestamps carry no zone, so their text form (used in trip_id and
# partition_month) does not depend on the session time zone.
TRIP_COLUMNS = {
    "VendorID": LongType(),
    "tpep_pickup_datetime": TimestampNTZType(),
    "tpep_dropoff_datetime": TimestampNTZType(),
    "passenger_count": DoubleType(),
    "trip_distance": DoubleType(),
    "RatecodeID": DoubleType(),
    "store_and_fwd_flag": StringType(),
    "PULocationID": LongType(),
    "DOLocationID": LongType(),
    "payment_type": LongType(),
    "fare_amount": DoubleType(),
    "extra": DoubleType(),
    "mta_tax": DoubleType(),
    "tip_amount": DoubleType(),
    "tolls_amount": DoubleType(),
    "improvement_surcharge": DoubleType(),
    "total_amount": DoubleType(),
    "congestion_surcharge": DoubleType(),
    "airport_fee": DoubleType(),
}
ZONE_COLUMNS = {
    "LocationID": IntegerType(),
    "Borough": StringType(),
    "Zone": StringType(),
    "service_zone": StringType(),
}

# Columns held as whole numbers from silver on.
NARROWED = ("passenger_count", "RatecodeID", "payment_type")

# Raw-table columns that may be NULL; every other raw column must not be.
RAW_TRIPS_NULLABLE = (
    "passenger_count",
    "RatecodeID",
    "congestion_surcharge",
    "airport_fee",
)


def _struct(columns, nullable=lambda name: True) -> StructType:
    return StructType([StructField(n, t, nullable(n)) for n, t in columns.items()])


_narrow = {n: IntegerType() for n in NARROWED}

BRONZE_TRIPS = _struct(TRIP_COLUMNS)
SILVER_TRIPS = _struct(
    TRIP_COLUMNS | _narrow | {"trip_id": StringType(), "partition_month": StringType()}
)
RAW_TRIPS = _struct(
    TRIP_COLUMNS | _narrow | {"payment_type": LongType()},
    lambda name: name in RAW_TRIPS_NULLABLE,
)
ZONES = _struct(ZONE_COLUMNS)
RAW_ZONES = _struct(ZONE_COLUMNS, lambda name: False)

# Staging names; columns that are not listed keep their raw name.
STAGING_TRIP_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}
STAGING_ZONE_NAMES = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
}
