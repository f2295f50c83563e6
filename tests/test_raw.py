from datetime import datetime, timedelta

import pytest
import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from triplake.functions.trips import prepare_trips
from triplake.schemas import RAW_TRIPS, RAW_ZONES, SILVER_TRIPS
from triplake.sources import raw


def silver(spark, *changes):
    return prepare_trips(rows.trips(spark, *changes)).drop("source_month")


@pytest.fixture
def tables(spark, database):
    name, location = database
    raw.create_tables(spark, name, location)
    return name


def trips_of(spark, tables):
    return spark.table(f"{tables}.raw_trips")


def test_tables_have_the_declared_types(spark, tables):
    fields = {f.name: f.dataType for f in trips_of(spark, tables).schema}
    assert fields.pop("month_key").simpleString() == "bigint"
    assert fields.pop("_run").simpleString() == "string"
    assert fields == {f.name: f.dataType for f in RAW_TRIPS}
    assert fields["payment_type"].simpleString() == "bigint"
    assert fields["passenger_count"].simpleString() == "int"
    zones = spark.table(f"{tables}.raw_zones").schema
    assert [(f.name, f.dataType) for f in zones][:-1] == [(f.name, f.dataType) for f in RAW_ZONES]


def test_creating_again_keeps_the_rows(spark, tables):
    raw.append_trips(silver(spark, {}), tables)
    raw.create_tables(spark, tables)
    assert trips_of(spark, tables).count() == 1


def test_append_adds_and_refresh_replaces(spark, tables):
    df, zones = silver(spark, {}, {}), rows.zones(spark, (1, "a", "b", "c"))
    assert raw.append_trips(df, tables) == 2
    assert raw.append_trips(df, tables) == 2
    assert trips_of(spark, tables).count() == 4
    for _ in range(2):
        counts = raw.full_refresh(spark, df.limit(1), zones, tables)
        assert counts == {"raw_trips": 1, "raw_zones": 1}
        assert trips_of(spark, tables).count() == 1
        assert spark.table(f"{tables}.raw_zones").count() == 1


def test_a_failing_refresh_leaves_the_old_rows(spark, tables):
    zones = rows.zones(spark, (1, "a", "b", "c"))
    raw.full_refresh(spark, silver(spark, {}, {}), zones, tables)
    with pytest.raises(Exception, match="NULL in a NOT NULL column"):
        raw.full_refresh(spark, silver(spark, {"extra": None}), zones, tables)
    assert trips_of(spark, tables).count() == 2
    assert spark.table(f"{tables}.raw_zones").count() == 1


def test_a_new_catalog_finds_what_was_loaded(spark, database):
    name, location = database
    raw.create_tables(spark, name, location)
    raw.full_refresh(spark, silver(spark, {}), rows.zones(spark, (1, "a", "b", "c")), name)
    spark.sql(f"DROP TABLE {name}.raw_trips")
    spark.sql(f"DROP TABLE {name}.raw_zones")
    raw.create_tables(spark, name, location)
    assert trips_of(spark, name).count() == 1
    assert spark.table(f"{name}.raw_zones").count() == 1


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_refresh_leaves_no_old_month(spark, tables, mode):
    old = {"tpep_pickup_datetime": datetime(2022, 3, 1)}
    zones = rows.zones(spark, (1, "a", "b", "c"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        raw.full_refresh(spark, silver(spark, old), zones, tables)
        raw.full_refresh(spark, silver(spark, {}), zones, tables)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.month_key for r in trips_of(spark, tables).collect()] == [202301]


def test_truncate_without_tables_is_no_error(spark, database):
    raw.truncate(spark, "default")


NULLS = {"extra": None, "store_and_fwd_flag": None, "congestion_surcharge": None}


def test_null_fails_the_load(spark, tables):
    with pytest.raises(PySparkException, match="NOT NULL column, one of: .*extra"):
        raw.append_trips(silver(spark, {}, NULLS), tables)
    assert trips_of(spark, tables).count() == 0
    counts = raw.null_counts(silver(spark, {}, NULLS), RAW_TRIPS).first().asDict()
    assert {k for k, n in counts.items() if n} == {"extra", "store_and_fwd_flag"}


def test_broken_rows_are_kept_apart(spark, tables):
    df = silver(spark, {}, {"extra": None}, {"extra": None, "fare_amount": None}, {"tpep_pickup_datetime": None})
    assert raw.append_trips(df, tables, on_null="reject") == 1
    assert trips_of(spark, tables).count() == 1
    required = [f.name for f in RAW_TRIPS if not f.nullable]
    bit = {name: 1 << i for i, name in enumerate(required)}
    found = raw.read_rejects(spark, tables, raw.TRIPS_TABLE).collect()
    assert sorted(r[raw.BROKEN] for r in found) == sorted(
        [bit["extra"], bit["extra"] | bit["fare_amount"], bit["tpep_pickup_datetime"]]
    )
    assert {r.month_key for r in found} == {202301, None}
    zones = rows.zones(spark, (1, "a", "b", "c"), (2, None, "b", None))
    assert raw.full_refresh(spark, df, zones, tables, on_null="reject") == {"raw_trips": 1, "raw_zones": 1}
    assert raw.read_rejects(spark, tables, raw.TRIPS_TABLE).count() == 3
    assert raw.read_rejects(spark, tables, raw.ZONES_TABLE).first()[raw.BROKEN] == 0b1010
    raw.full_refresh(spark, df.limit(1), zones.limit(1), tables)
    assert raw.read_rejects(spark, tables, raw.TRIPS_TABLE).count() == 0
    raw.full_refresh(spark, df, zones, tables, on_null="reject")
    raw.truncate(spark, tables)
    assert raw.read_rejects(spark, tables, raw.ZONES_TABLE).count() == trips_of(spark, tables).count() == 0
    with pytest.raises(ValueError, match="on_null"):
        raw.write_jdbc(df, RAW_TRIPS, {}, on_null="reject")


@pytest.mark.parametrize("column", [f.name for f in RAW_TRIPS if not f.nullable])
def test_every_required_column_is_checked(spark, column):
    with pytest.raises(PySparkException, match="NOT NULL column"):
        raw.to_contract(silver(spark, {}, {column: None}), RAW_TRIPS).collect()


def test_the_check_is_not_pruned_away(spark):
    rows = raw.to_contract(silver(spark, {}, {"extra": None}), RAW_TRIPS)
    with pytest.raises(PySparkException, match="NOT NULL column"):
        rows.select("total_amount").collect()
    with pytest.raises(PySparkException, match="NOT NULL column"):
        rows.count()


def test_null_becomes_the_default(spark, tables):
    raw.append_trips(silver(spark, NULLS), tables, on_null="default")
    row = trips_of(spark, tables).first()
    assert (row.extra, row.store_and_fwd_flag) == (0.0, "")
    assert row.congestion_surcharge is None


def test_nullable_columns_may_be_null(spark, tables):
    nulls = dict.fromkeys(
        ("passenger_count", "RatecodeID", "congestion_surcharge", "airport_fee")
    )
    assert raw.append_trips(silver(spark, nulls), tables) == 1


def test_default_of_each_type(spark):
    empty = spark.createDataFrame([(None,) * len(SILVER_TRIPS)], SILVER_TRIPS)
    row = raw.to_contract(empty, RAW_TRIPS, "default").first()
    assert row.tpep_pickup_datetime == datetime(1970, 1, 1)
    assert (row.VendorID, row.fare_amount, row.store_and_fwd_flag) == (0, 0.0, "")
    with pytest.raises(ValueError, match="on_null"):
        raw.to_contract(empty, RAW_TRIPS, "ignore")


def key_of(row):
    return row.month_key, row.tpep_pickup_datetime, row.PULocationID


def stored_by_file(spark, table):
    files = {}
    stored = spark.table(table).select(
        "*", "_metadata.file_path", F.col("_metadata.row_index").alias("i")
    )
    for row in stored.collect():
        files.setdefault(row.file_path, []).append(row)
    return [sorted(f, key=lambda r: r.i) for f in files.values()]


def shuffled_trips(n):
    start = datetime(2023, 1, 1)
    return [
        {
            "tpep_pickup_datetime": start + timedelta(minutes=i * 7919 % 80000),
            "PULocationID": i % 5,
        }
        for i in range(n)
    ]


def test_files_are_sorted_without_a_shuffle(spark, tables):
    df = silver(spark, *shuffled_trips(400)).repartition(3)
    raw.append_trips(df, tables)
    files = stored_by_file(spark, f"{tables}.raw_trips")
    assert sum(map(len, files)) == 400
    for file in files:
        assert [key_of(r) for r in file] == sorted(map(key_of, file))
    plan = raw.lay_out_trips(raw.to_contract(silver(spark, {}), RAW_TRIPS))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_ranges_do_not_overlap(spark, tables):
    raw.append_trips(silver(spark, *shuffled_trips(400)), tables, files=4)
    months = {}
    for file in stored_by_file(spark, f"{tables}.raw_trips"):
        assert [key_of(r) for r in file] == sorted(map(key_of, file))
        months.setdefault(file[0].month_key, []).append((key_of(file[0]), key_of(file[-1])))
    for spans in months.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_hot_key_is_spread_over_ranges(spark, tmp_path):
    """Exact copies of one trip make most rows; no task may get them all."""
    path = str(tmp_path / "silver")
    copies = silver(spark, {}).crossJoin(spark.range(3000)).drop("id")
    copies.unionByName(silver(spark, *shuffled_trips(1000))).write.parquet(path)
    laid = raw.lay_out_trips(spark.read.parquet(path), files=8)
    sizes = [
        r.n
        for r in laid.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    ]
    assert sum(sizes) == 4000
    assert max(sizes) < 4000 / 3


def test_jdbc_goes_to_the_jdbc_source(spark):
    """There is no database here, so only the way to it can be seen."""
    options = {"url": "jdbc:none:lake", "dbtable": "raw_trips", "user": "u", "password": "p"}
    for refresh in (False, True):
        with pytest.raises(Py4JJavaError, match="No suitable driver"):
            raw.write_jdbc(silver(spark, {}), RAW_TRIPS, options, refresh)


class Recorder:
    """Stands for a DataFrame's writer and keeps what it is told."""

    def __init__(self):
        self.said = {}

    def format(self, name):
        self.said["format"] = name
        return self

    def options(self, **options):
        self.said.update(options)
        return self

    def option(self, name, value):
        self.said[name] = value
        return self

    def mode(self, mode):
        self.said["mode"] = mode
        return self

    def save(self):
        self.said["saved"] = True


@pytest.mark.parametrize(
    "refresh, expected",
    [(False, {"mode": "append"}), (True, {"mode": "overwrite", "truncate": True})],
)
def test_jdbc_options(spark, monkeypatch, refresh, expected):
    writer, written = Recorder(), []

    class Contract:
        write = writer

    monkeypatch.setattr(raw, "_counted", lambda rows: (rows, lambda: 5))

    def contract(df, schema, on_null):
        written.append((schema, on_null))
        return Contract()

    monkeypatch.setattr(raw, "to_contract", contract)
    assert raw.write_jdbc(None, RAW_ZONES, {"url": "u", "numPartitions": "8"}, refresh) == 5
    assert writer.said == {
        "format": "jdbc",
        "url": "u",
        "numPartitions": "8",
        "saved": True,
        **expected,
    }
    assert written == [(RAW_ZONES, "fail")]
