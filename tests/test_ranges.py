from datetime import datetime, timedelta

import pytest
import rows
from pyspark.sql import functions as F
from triplake.functions.trips import prepare_trips
from triplake.sources import raw
from triplake.sources.ranges import files_of

START = datetime(2023, 1, 1)


def silver(spark, n, step=timedelta(hours=1), start=START):
    """``n`` trips, one each ``step``, in an order that is not theirs."""
    at = [start + i * 37 % n * step for i in range(n)]
    changes = [{"tpep_pickup_datetime": t, "PULocationID": i % 5} for i, t in enumerate(at)]
    return prepare_trips(rows.trips(spark, *changes)).drop("source_month")


@pytest.fixture
def tables(spark, database):
    name, location = database
    raw.create_tables(spark, name, location)
    return name


def whole(spark, tables, start, end):
    trips = raw.read_table(spark, tables, raw.TRIPS_TABLE)
    at = F.col(raw.PICKUP)
    low, high = (F.lit(str(t)).cast("timestamp_ntz") for t in (start, end))
    return trips.filter((at >= low) & (at < high))


def same_as_whole(spark, tables, start, end):
    """The slice's rows are those of a full read, and its files those that hold them."""
    found, wanted = raw.read_slice(spark, tables, start, end), whole(spark, tables, start, end)
    assert rows.multiset(found) == rows.multiset(wanted)
    return len(found.inputFiles()), wanted.select("_metadata.file_path").distinct().count()


def test_a_slice_reads_the_files_that_hold_it(spark, tables):
    assert raw.append_trips(silver(spark, 700), tables, rows_per_file=50) == 700
    ranges = raw.read_ranges(spark, tables)
    assert ranges.agg(F.sum("n_rows")).first()[0] == 700
    assert ranges.count() >= 14
    for first, hours in ((0, 1), (100, 48), (300, 400), (0, 700)):
        start = START + timedelta(hours=first)
        read, holding = same_as_whole(spark, tables, start, start + timedelta(hours=hours))
        assert read == holding
    assert same_as_whole(spark, tables, START, START + timedelta(hours=20))[0] <= 2


def test_bounds_are_half_open_and_may_lie_between_rows(spark, tables):
    raw.append_trips(silver(spark, 48), tables, rows_per_file=8)
    hour = timedelta(hours=1)
    assert raw.read_slice(spark, tables, START, START + hour).count() == 1
    assert raw.read_slice(spark, tables, START, START).count() == 0
    assert raw.read_slice(spark, tables, START + hour, START).count() == 0
    assert raw.read_slice(spark, tables, START + hour / 4, START + hour / 2).count() == 0
    assert raw.read_slice(spark, tables, START - 9 * hour, START).count() == 0
    with pytest.raises(ValueError, match="zone"):
        raw.read_slice(spark, tables, START.astimezone(), START)


def test_another_session_zone_changes_nothing(spark, tables):
    raw.append_trips(silver(spark, 100), tables, rows_per_file=10)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = raw.read_slice(spark, tables, START, START + timedelta(hours=10))
        assert found.count() == 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_time_of_a_third_of_all_rows_is_held_by_several_files(spark, tables):
    changes = [{"tpep_pickup_datetime": START}] * 200
    hot = prepare_trips(rows.trips(spark, *changes)).drop("source_month")
    raw.append_trips(hot.union(silver(spark, 400, start=START + timedelta(hours=1))), tables, rows_per_file=40)
    read, holding = same_as_whole(spark, tables, START, START + timedelta(minutes=1))
    assert read == holding >= 4
    sizes = [r.n_rows for r in raw.read_ranges(spark, tables).collect()]
    assert max(sizes) <= 120


def test_runs_without_ranges_are_read_as_they_are(spark, tables):
    raw.append_trips(silver(spark, 60), tables, rows_per_file=10)
    raw.append_trips(silver(spark, 40), tables)
    raw.append_trips(silver(spark, 30, start=datetime(2023, 2, 1)), tables)
    same_as_whole(spark, tables, START, START + timedelta(hours=5))
    same_as_whole(spark, tables, START, datetime(2023, 3, 1))


def test_ranges_follow_the_months_that_are_replaced(spark, tables):
    zones = rows.zones(spark, (1, "a", "b", "c"))
    january, february = silver(spark, 100), silver(spark, 100, start=datetime(2023, 2, 1))
    raw.full_refresh(spark, january.union(february), zones, tables, rows_per_file=20)
    before = raw.table_log(spark, tables).latest()
    raw.full_refresh(spark, january.limit(30), zones, tables, months=[202301], rows_per_file=10)
    by_month = raw.read_ranges(spark, tables).groupBy("month_key").agg(F.sum("n_rows")).collect()
    assert {tuple(r) for r in by_month} == {(202301, 30), (202302, 100)}
    read, holding = same_as_whole(spark, tables, START, datetime(2023, 2, 2))
    assert read == holding
    # An older snapshot keeps its own files.
    assert raw.read_slice(spark, tables, START, datetime(2023, 2, 2), before).count() == 124
    # Without ranges there are none left over.
    raw.full_refresh(spark, january, zones, tables, months=[202301])
    assert raw.read_ranges(spark, tables).filter("month_key = 202301").count() == 0
    same_as_whole(spark, tables, START, START + timedelta(hours=5))
    raw.truncate(spark, tables)
    assert raw.read_ranges(spark, tables).count() == 0
    assert raw.read_slice(spark, tables, START, datetime(2024, 1, 1)).count() == 0


def test_a_load_without_rows_has_no_ranges(spark, tables):
    assert raw.append_trips(silver(spark, 5).limit(0), tables, rows_per_file=10) == 0
    assert raw.read_ranges(spark, tables).count() == 0


def test_rejected_rows_are_in_no_range(spark, tables):
    broken = prepare_trips(rows.trips(spark, {"fare_amount": None}, {})).drop("source_month")
    assert raw.append_trips(broken, tables, on_null="reject", files=2) == 1
    assert raw.read_ranges(spark, tables).agg(F.sum("n_rows")).first()[0] == 1
    assert raw.read_rejects(spark, tables, raw.TRIPS_TABLE).count() == 1
    only = prepare_trips(rows.trips(spark, {"fare_amount": None})).drop("source_month")
    assert raw.append_trips(only, tables, on_null="reject", files=2) == 0
    assert raw.read_ranges(spark, tables).agg(F.sum("n_rows")).first()[0] == 1


def test_rows_per_file(spark):
    assert [files_of(spark.range(n), 10) for n in (0, 1, 10, 11)] == [1, 1, 1, 2]
    with pytest.raises(ValueError):
        files_of(spark.range(1), 0)
