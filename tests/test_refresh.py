from datetime import datetime, timedelta
from pathlib import Path

import pytest
import rows
from pyspark.sql import functions as F
from test_bronze import drifted
from triplake.plans import models
from triplake.plans.refresh import Lake, Policy, clean_trips, refresh
from triplake.schemas import SILVER_TRIPS
from triplake.sources import bronze, raw
from triplake.sources import lake as store


@pytest.fixture
def place(spark, tmp_path, database):
    name, location = database
    return Lake(str(tmp_path / "bronze"), str(tmp_path / "lake"), name, location)


def deliver(spark, folder):
    """Three drifted months, each trip in January 2023, and a zone lookup."""
    drifted(spark, folder)
    (folder / "taxi_zone_lookup.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n"
        "7,Queens,Astoria,Boro Zone\n"
        "8,Bronx,Belmont,Boro Zone\n"
        "x,Queens,Nowhere,Boro Zone\n"
    )


EXPECTED = {
    "trips": {"n_read": 6, "n_clean": 2, "n_quarantined": 4, "n_unjudged": 0},
    "zones": {"n_read": 3, "n_clean": 2, "n_quarantined": 1, "n_unjudged": 0},
    "raw": {"raw_trips": 2, "raw_zones": 2},
}


def test_refresh_twice_gives_the_same(spark, tmp_path, place):
    deliver(spark, tmp_path / "bronze")
    for _ in range(2):
        assert refresh(spark, place) == EXPECTED
        mart = spark.table(f"{place.database}.{models.REVENUE_MART}")
        assert [tuple(r) for r in mart.collect()] == [("Queens", 2, 30.0)]
        silver = store.read_clean(spark, place.trips, SILVER_TRIPS)
        assert {r.partition_month for r in silver.collect()} == {"2023-01"}


def test_views_are_what_the_functions_give(spark, tmp_path, place):
    deliver(spark, tmp_path / "bronze")
    for unmatched in models.UNMATCHED:
        refresh(spark, place, Policy(unmatched=unmatched))

        def table(name):
            return spark.table(f"{place.database}.{name}")

        trips, zones = models.stg_trips(table("raw_trips")), models.stg_zones(table("raw_zones"))
        for view, df in (
            (models.STG_TRIPS, trips),
            (models.STG_ZONES, zones),
            (models.TRIPS_WITH_ZONES, models.int_trips_with_zones(trips, zones, unmatched)),
        ):
            assert table(view).columns == df.columns
            assert rows.multiset(table(view)) == rows.multiset(df)


def test_views_follow_their_tables(spark, tmp_path, place):
    deliver(spark, tmp_path / "bronze")
    refresh(spark, place)
    raw.truncate(spark, place.database)
    assert spark.table(f"{place.database}.{models.TRIPS_WITH_ZONES}").count() == 0


def test_landing_comes_first(spark, tmp_path, place):
    source = tmp_path / "source"
    source.mkdir()
    deliver(spark, source)
    wanted = spark.createDataFrame(
        [(p.name, str(p)) for p in source.iterdir()], "object_name string, source_path string"
    )
    first = refresh(spark, place, wanted=wanted)
    # Rows, so the header line of the zones does not count.
    assert sum(first.pop("landed").values()) == 6 + 3
    assert first == EXPECTED
    again = refresh(spark, place, wanted=wanted)
    assert again == {"landed": {}, **EXPECTED}


def test_policies_reach_their_stage(spark, tmp_path, place):
    source = tmp_path / "bronze"
    deliver(spark, source)
    odd = rows.trips(spark, {"fare_amount": None}, {"extra": None}).drop("source_month")
    odd.write.parquet(f"{source}/yellow_tripdata_2023-01.parquet.parquet")
    odd.write.mode("append").parquet(f"{source}/yellow_tripdata_2023-01.parquet")
    with pytest.raises(Exception, match="NOT NULL column"):
        refresh(spark, place)
    audit = refresh(spark, place, Policy("quarantine", "default", money="decimal", files=2))
    assert audit["trips"]["n_unjudged"] == 0
    assert audit["raw"]["raw_trips"] == 3
    extra = spark.table(f"{place.database}.raw_trips").agg(F.sum("extra")).first()[0]
    assert extra == 0.0


def good(spark, month, *amounts):
    """Trips that lie in ``month``, as its object delivers them."""
    day = datetime(int(month[:4]), int(month[5:]), 5, 10)
    times = {"tpep_pickup_datetime": day, "tpep_dropoff_datetime": day + timedelta(hours=1)}
    return rows.trips(spark, *(times | {"total_amount": a} for a in amounts)).drop("source_month")


def deliver_months(spark, folder, months):
    for month, amounts in months.items():
        good(spark, month, *amounts).write.mode("overwrite").parquet(f"{folder}/yellow_tripdata_{month}.parquet")


def mart_of(spark, place):
    return sorted(map(tuple, spark.table(f"{place.database}.{models.REVENUE_MART}").collect()))


def runs_of(spark, place, table):
    parts = raw.table_log(spark, place.database).latest().parts
    return {part: runs for part, runs in parts.items() if raw.holds(table)(part)}


def test_one_month_goes_through_to_the_mart(spark, tmp_path, place, monkeypatch):
    deliver(spark, tmp_path / "bronze")
    deliver_months(spark, tmp_path / "bronze", {"2023-01": [0.1], "2023-02": [0.2, 0.7], "2023-03": [0.3]})
    refresh(spark, place)
    assert mart_of(spark, place) == [("Queens", 4, 1.3)]
    tables = (raw.TRIPS_TABLE, models.mart_parts())
    before = {t: runs_of(spark, place, t) for t in tables}
    # February comes with other trips and March with none that are clean.
    deliver_months(spark, tmp_path / "bronze", {"2023-02": [0.4], "2023-03": [0.5]})
    empty = good(spark, "2023-03", 1.0).withColumn("fare_amount", F.lit(-1.0))
    empty.write.mode("overwrite").parquet(f"{tmp_path}/bronze/yellow_tripdata_2023-03.parquet")
    read = []
    whole = models.stg_trips
    monkeypatch.setattr(models, "stg_trips", lambda df: read.append(df.count()) or whole(df))
    audit = refresh(spark, place, Policy(months=("2023-02", "2023-03")))
    assert audit["trips"]["n_read"] == 2 and audit["raw"][raw.TRIPS_TABLE] == 1
    assert mart_of(spark, place) == [("Queens", 2, 0.5)]
    assert spark.table(f"{place.database}.raw_trips").count() == 2
    # Only February's trips were read for the mart, and only its files are new.
    assert read == [1]
    for table in tables:
        after = runs_of(spark, place, table)
        kept = {part for part in after if after[part] == before[table].get(part)}
        assert {p.rpartition("=")[2] for p in after} == {"202301", "202302"}
        assert {p.rpartition("=")[2] for p in kept} == {"202301"}
    # All of it again gives the same.
    refresh(spark, place)
    assert mart_of(spark, place) == [("Queens", 2, 0.5)]


def test_other_zones_make_all_months_anew(spark, tmp_path, place):
    deliver(spark, tmp_path / "bronze")
    deliver_months(spark, tmp_path / "bronze", {"2023-01": [1.0], "2023-02": [2.0]})
    refresh(spark, place)
    zones = tmp_path / "bronze" / place.zones_name
    zones.write_text(zones.read_text().replace("7,Queens", "7,Manhattan"))
    refresh(spark, place, Policy(months=("2023-02",)))
    assert mart_of(spark, place) == [("Manhattan", 2, 3.0)]


def test_appended_trips_come_into_the_mart(spark, tmp_path, place):
    deliver(spark, tmp_path / "bronze")
    deliver_months(spark, tmp_path / "bronze", {"2023-01": [1.0], "2023-02": [2.0]})
    refresh(spark, place)
    january = store.read_clean(spark, place.trips, SILVER_TRIPS).filter("partition_month = '2023-01'")
    raw.append_trips(january, place.database)
    assert models.build_mart(spark, place.database).collect() == [("Queens", 3, 4.0)]
    assert spark.table(f"{place.database}.raw_trips").count() == 3


def test_months_that_were_never_loaded_come_along(spark, tmp_path, place):
    deliver(spark, tmp_path / "bronze")
    deliver_months(spark, tmp_path / "bronze", {"2023-01": [1.0], "2023-02": [2.0]})
    trips = bronze.read_bronze_trips(spark, f"{place.bronze}/*.parquet")
    clean_trips(trips, place)
    refresh(spark, place, Policy(months=("2023-02",)))
    assert mart_of(spark, place) == [("Queens", 2, 3.0)]


def test_a_reader_between_two_registrations_sees_one_load(spark, tmp_path, place, monkeypatch):
    deliver(spark, tmp_path / "bronze")
    deliver_months(spark, tmp_path / "bronze", {"2023-01": [1.0], "2023-02": [2.0]})
    refresh(spark, place)
    log, seen = raw.table_log(spark, place.database), []

    def look(register):
        def looking(*args):
            snapshot = log.latest()
            tables = [raw.read_table(spark, place.database, t, snapshot) for t in raw.TABLES]
            seen.append((tables[0].count(), sorted(r.Zone for r in tables[1].collect())))
            register(*args)

        return looking

    monkeypatch.setattr(raw, "register", look(raw.register))
    first = log.latest()
    trips = store.read_clean(spark, place.trips, SILVER_TRIPS)
    zones = rows.zones(spark, (7, "Queens", "New", "x"))
    raw.full_refresh(spark, trips.limit(1), zones, place.database)
    assert seen == [(1, ["New"])] * 2
    assert raw.read_table(spark, place.database, raw.TRIPS_TABLE, first).count() == 2
    assert raw.read_table(spark, place.database, raw.ZONES_TABLE, first).count() == 2


def test_ten_refreshes_leave_few_folders(spark, tmp_path, place):
    deliver(spark, tmp_path / "bronze")
    counts = []
    for _ in range(5):
        refresh(spark, place, Policy(keep=2, grace_seconds=0))
        folders = [log.rglob("_run=*") for log in (tmp_path / "lake", Path(place.database_location))]
        counts.append(sum(len({p.name for p in found}) for found in folders))
    assert counts[-1] == counts[-2] == counts[-3] and mart_of(spark, place) == [("Queens", 2, 30.0)]
