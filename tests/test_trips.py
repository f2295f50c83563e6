import hashlib

import rows
from pyspark.sql import functions as F
from triplake.functions import trips as T


def key(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prepared(spark, *changes, **more):
    return T.prepare_trips(rows.trips(spark, *changes, **more)).collect()


def test_source_month(spark):
    names = {
        "yellow_tripdata_2023-01.parquet": "2023-01",
        "other_2023-01.parquet": "other_2023-01",
        "yellow_tripdata_2023-01.csv": "2023-01.csv",
        "2023-01": "2023-01",
        "yellow_tripdata_.parquet": "",
        "yellow_tripdata_yellow_tripdata_x.parquet.parquet": "yellow_tripdata_x.parquet",
    }
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = df.select("name", T.source_month(F.col("name")).alias("month")).collect()
    assert dict(map(tuple, found)) == names
    for name, month in names.items():
        start, length = T.month_span(name)
        assert name[start : start + length] == month


def test_source_month_of_path(spark):
    name = "yellow_tripdata_2023-01.parquet"
    df = spark.createDataFrame(
        [
            (f"file:/lake/bronze/{name}",),
            (f"file:///lake/bronze/{name}/part-0.parquet",),
            (f"s3a://lake/bronze/{name}/a=1/part-0.parquet",),
        ],
        "path string",
    )
    month = T.source_month_of_path(F.col("path"), "s3a://lake/bronze", T.month_span(name))
    assert {r[0] for r in df.select(month).collect()[2:]} == {"2023-01"}
    month = T.source_month_of_path(F.col("path"), "file:/lake/bronze", T.month_span(name))
    assert {r[0] for r in df.select(month).collect()[:2]} == {"2023-01"}
    top = spark.createDataFrame([(f"s3a://bronze/{name}",)], "path string")
    month = T.source_month_of_path(F.col("path"), "s3a://bronze", T.month_span(name))
    assert top.select(month).first()[0] == "2023-01"


def test_trip_id_text(spark):
    plain, large, small = prepared(
        spark, {}, {"total_amount": 1e7}, {"total_amount": 1e-4}
    )
    head = "1|2023-01-05 10:00:00|2023-01-05 10:20:00|7|8|"
    assert plain.trip_id == key(head + "15.0")
    assert large.trip_id == key(head + "1.0E7")
    assert small.trip_id == key(head + "1.0E-4")


def test_trip_id_skips_null_so_keys_can_collide(spark):
    one, two = prepared(
        spark,
        {"VendorID": None, "PULocationID": 7, "DOLocationID": 8},
        {"VendorID": None, "PULocationID": 7, "DOLocationID": 8, "extra": 9.0},
    )
    assert one.trip_id == two.trip_id
    assert one.trip_id == key("2023-01-05 10:00:00|2023-01-05 10:20:00|7|8|15.0")


def test_narrowing_truncates_and_never_fails(spark):
    found = prepared(
        spark,
        {"passenger_count": 1.9},
        {"passenger_count": float("nan")},
        {"passenger_count": 1e12},
        {"payment_type": 3_000_000_000, "RatecodeID": -1e12},
    )
    assert [r.passenger_count for r in found] == [1, None, None, 2]
    assert (found[3].payment_type, found[3].RatecodeID) == (None, None)


def test_months(spark):
    df = T.prepare_trips(rows.trips(spark, {}, {"tpep_pickup_datetime": None}))
    found = df.select("partition_month", T.month_key().alias("k")).collect()
    assert [tuple(r) for r in found] == [("2023-01", 202301), (None, None)]
    assert df.select(T.month_key().alias("k")).dtypes == [("k", "bigint")]


def test_text_does_not_depend_on_the_session_zone(spark):
    before = prepared(spark, {})
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert prepared(spark, {}) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
