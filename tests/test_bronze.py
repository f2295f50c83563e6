from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import rows
from pyspark.sql import functions as F
from triplake.schemas import BRONZE_TRIPS, ZONES
from triplake.sources import bronze


def write_object(df, folder, name):
    df.drop("source_month").write.parquet(f"{folder}/{name}")


def write_file(df, folder, name):
    """A delivered object that is a single file."""
    folder.mkdir(parents=True, exist_ok=True)
    df.drop("source_month").toPandas().to_parquet(folder / name, coerce_timestamps="us")


def by_month(df):
    return {r[0]: r[1] for r in df.groupBy("source_month").count().collect()}


def drifted(spark, bronze_dir):
    """Three months whose physical schemas do not fit together."""
    a = rows.trips(spark, {"airport_fee": 1.25}, {"airport_fee": 0.0})
    write_object(
        a.withColumnRenamed("airport_fee", "Airport_fee"),
        bronze_dir,
        "yellow_tripdata_2023-01.parquet",
    )
    b = rows.trips(spark, {"airport_fee": 5.0}).withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("bigint"),
            "VendorID": F.col("VendorID").cast("int"),
        }
    )
    write_object(b, bronze_dir, "yellow_tripdata_2023-02.parquet")
    c = rows.trips(spark, {}, {}, {}).drop("congestion_surcharge")
    write_object(
        c.select(*reversed(c.columns)), bronze_dir, "yellow_tripdata_2023-03.parquet"
    )


def test_drifted_months_become_one_frame(spark, tmp_path):
    drifted(spark, tmp_path)
    df = bronze.read_bronze_trips(spark, f"{tmp_path}/*.parquet")
    assert df.columns == [*BRONZE_TRIPS.names, "source_month"]
    assert [f.dataType for f in df.schema][:19] == [f.dataType for f in BRONZE_TRIPS]
    assert by_month(df) == {"2023-01": 2, "2023-02": 1, "2023-03": 3}
    found = {(r.source_month, r.congestion_surcharge, r.airport_fee) for r in df.collect()}
    assert found == {
        ("2023-01", 2.5, 1.25),
        ("2023-01", 2.5, 0.0),
        ("2023-02", 2.5, 5.0),
        ("2023-03", None, None),
    }
    assert {r.passenger_count for r in df.collect()} == {2.0}


def test_one_read_for_each_schema(spark, tmp_path):
    for month in range(1, 7):
        df = rows.trips(spark, {})
        if month % 2:
            df = df.select(*reversed(df.columns))
        if month > 3:
            df = df.withColumn("VendorID", F.col("VendorID").cast("int"))
        write_object(df, tmp_path, f"yellow_tripdata_2023-0{month}.parquet")
    objects = bronze.glob_objects(spark, f"{tmp_path}/*.parquet")
    assert [len(g.paths) for g in bronze.group_objects(spark, objects)] == [3, 3]
    assert len(by_month(bronze.read_bronze_trips(spark, f"{tmp_path}/*.parquet"))) == 6


def jobs_of(spark, name, job):
    spark.sparkContext.setJobGroup(name, name)
    try:
        job()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_more_objects_take_no_more_jobs(spark, tmp_path):
    """Footers are read by the tasks of one job, whatever the number of objects."""
    for n, start in ((33, 0), (33, 33)):
        for i in range(start, start + n):
            df = rows.trips(spark, {}).coalesce(1)
            write_object(df.drop("airport_fee") if i % 2 else df, tmp_path, f"yellow_tripdata_{2000 + i}-01.parquet")
        objects = bronze.glob_objects(spark, f"{tmp_path}/*.parquet")
        made = jobs_of(spark, f"schemas {start}", lambda: bronze.object_schemas(spark, objects))
        if not start:
            first = made
    assert len(objects) == 66 and made == first <= 8


def test_groups_from_footers(spark, tmp_path):
    drifted(spark, tmp_path)
    write_file(rows.trips(spark, {}, {}), tmp_path, "yellow_tripdata_2023-04.parquet")
    parts = rows.trips(spark, {}), rows.trips(spark, {}, {}).drop("airport_fee")
    for part in parts:
        part.drop("source_month").write.mode("append").parquet(f"{tmp_path}/yellow_tripdata_2023-05.parquet")
    objects = bronze.glob_objects(spark, f"{tmp_path}/*.parquet")
    groups = bronze.schema_groups(spark, objects).collect()
    months = {tuple(n[-10:-8] for n in g.objects): (g.n_rows, "airport_fee double" in g.columns) for g in groups}
    assert months == {("01",): (2, False), ("02",): (1, True), ("03",): (3, True), ("04",): (2, False), ("05",): (3, True)}
    # Spark derives types as it would for each object by itself.
    schemas = bronze.object_schemas(spark, objects)
    for obj, schema in zip(objects, schemas):
        alone = bronze.merged_parts(spark, obj.path).schema
        assert {(f.name, f.dataType) for f in schema} == {(f.name, f.dataType) for f in alone}


def test_single_files_and_folders_mix(spark, tmp_path):
    df = rows.trips(spark, {}, {})
    write_file(df, tmp_path, "yellow_tripdata_2023-01.parquet")
    write_object(df, tmp_path, "yellow_tripdata_2023-02.parquet")
    found = bronze.read_bronze_trips(spark, f"{tmp_path}/*.parquet")
    assert by_month(found) == {"2023-01": 2, "2023-02": 2}


def test_types_that_other_writers_use(spark, tmp_path):
    """Columns without a type, narrow numbers, coded text and zoned times."""
    times = [datetime(2023, 1, 5, 10), None]
    for month, zone in (("01", None), ("02", "UTC")):
        table = pa.table(
            {
                "VendorID": pa.array([1, 2], pa.int32()),
                "tpep_pickup_datetime": pa.array(times, pa.timestamp("us", tz=zone)),
                "Airport_fee": pa.nulls(2),
                "congestion_surcharge": pa.array([1, None], pa.int64()),
                "store_and_fwd_flag": pa.array(["Y", None]).dictionary_encode(),
            }
        )
        pq.write_table(table, tmp_path / f"yellow_tripdata_2023-{month}.parquet")
    df = bronze.read_bronze_trips(spark, f"{tmp_path}/*.parquet")
    names = ["VendorID", "tpep_pickup_datetime", "airport_fee", "congestion_surcharge"]
    found = [tuple(r) for r in df.select(*names, "store_and_fwd_flag").collect()]
    assert found == [(1, times[0], None, 1.0, "Y"), (2, None, None, None, None)] * 2


def test_names_with_escapes(spark, tmp_path):
    df = rows.trips(spark, {})
    names = {
        "yellow_tripdata_2023 01.parquet": "2023 01",
        "100%_2023+01.parquet": "100%_2023+01",
        "yellow_tripdata_2023+02.parquet": "2023+02",
        "other_2023-01.parquet": "other_2023-01",
    }
    for name in names:
        write_object(df, tmp_path / "a b", name)
    found = bronze.read_bronze_trips(spark, f"{tmp_path}/a b/*.parquet")
    assert by_month(found) == {month: 1 for month in names.values()}


def test_objects_of_several_folders(spark, tmp_path):
    for folder in ("x", "y"):
        write_object(rows.trips(spark, {}), tmp_path / folder, "yellow_tripdata_2023-01.parquet")
    found = bronze.read_bronze_trips(spark, f"{tmp_path}/*/*.parquet")
    assert by_month(found) == {"2023-01": 2}


def test_nothing_delivered_is_an_error(spark, tmp_path):
    for pattern in (f"{tmp_path}/*.parquet", f"{tmp_path}/absent/*.parquet"):
        with pytest.raises(FileNotFoundError):
            bronze.read_bronze_trips(spark, pattern)


def test_objects_come_in_name_order(spark, tmp_path):
    for month in ("03", "01", "02"):
        write_object(rows.trips(spark, {}), tmp_path, f"{month}.parquet")
    names = [o.name for o in bronze.glob_objects(spark, f"{tmp_path}/*.parquet")]
    assert names == ["01.parquet", "02.parquet", "03.parquet"]


def test_zones_csv(spark, tmp_path):
    path = tmp_path / "taxi_zone_lookup.csv"
    path.write_text(
        "LocationID,Borough,Zone,service_zone\n"
        '1,"EWR","Newark Airport","EWR"\n'
        "x,Queens,Astoria,Boro Zone\n"
        "3,Bronx\n"
        '4,"","Alphabet City",Yellow Zone\n'
        "5,  ,Arden Heights,N/A\n"
        '6,"Staten, Island",Arrochar,Boro Zone,more\n'
    )
    df = bronze.read_zones_csv(spark, str(path))
    assert df.schema == ZONES
    assert [tuple(r) for r in df.collect()] == [
        (1, "EWR", "Newark Airport", "EWR"),
        (None, "Queens", "Astoria", "Boro Zone"),
        (3, "Bronx", None, None),
        (4, None, "Alphabet City", "Yellow Zone"),
        (5, "  ", "Arden Heights", "N/A"),
        (6, "Staten, Island", "Arrochar", "Boro Zone"),
    ]


def test_zones_csv_goes_by_position(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("Borough,LocationID,Zone,service_zone\nQueens,7,Astoria,Boro Zone\n")
    assert tuple(bronze.read_zones_csv(spark, str(path)).first()) == (
        None,
        "7",
        "Astoria",
        "Boro Zone",
    )


def test_bad_lines_have_a_reason(spark, tmp_path):
    path = tmp_path / "zones.csv"
    header = "LocationID,Borough,Zone,service_zone\n"
    path.write_text(header + '1,"a, b",c,d\nx,b,c,d\n2,b\n3,b,c,d,e\n4,"",c,\n99999999999,b,c,d\n\n')
    found = {r.line: r.reason for r in bronze.zones_csv_rejects(spark, str(path)).collect()}
    assert found == {
        "x,b,c,d": bronze.TYPE, "99999999999,b,c,d": bronze.TYPE, "2,b": bronze.FIELDS, "3,b,c,d,e": bronze.FIELDS,
    }


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("Borough,LocationID,Zone,service_zone\nQueens,7,Astoria,Boro Zone\n")
    for read in (bronze.zones_csv_rejects, lambda *a: bronze.read_zones_csv(*a, check_header=True)):
        with pytest.raises(Exception, match="(?i)header"):
            read(spark, str(path)).collect()
    path.write_text("LocationID,Borough,Zone,service_zone\n7,Queens,Astoria,Boro Zone\n")
    assert bronze.read_zones_csv(spark, str(path), check_header=True).count() == 1
    assert bronze.zones_csv_rejects(spark, str(path)).count() == 0
