from datetime import datetime
from pathlib import Path

import pytest
import rows
from pyspark.sql import functions as F
from triplake.functions.trips import prepare_trips
from triplake.operators import quality
from triplake.operators.quality import trip_rules, zone_rules
from triplake.schemas import SILVER_TRIPS, ZONES
from triplake.sources import lake

MIXED_MONTH = datetime(2022, 6, 6)
MIXED = [
    {},
    {},
    {"fare_amount": 0.0},
    {"fare_amount": None},
    {"tpep_pickup_datetime": None},
    {"tpep_pickup_datetime": datetime(2098, 9, 11), "fare_amount": 0.0},
]


def mixed(spark):
    january = rows.trips(spark, *MIXED)
    moved = {
        "tpep_pickup_datetime": datetime(2023, 2, 5, 10),
        "tpep_dropoff_datetime": datetime(2023, 2, 5, 11),
    }
    return prepare_trips(january.unionByName(rows.trips(spark, moved, month="2023-02")))


@pytest.mark.parametrize("null_verdict", quality.NULL_VERDICTS)
def test_one_pass_stores_what_the_split_gives(spark, tmp_path, null_verdict):
    df = mixed(spark)
    counts = lake.write_split(df, trip_rules(), str(tmp_path / "t"), null_verdict)
    parts = quality.split(df.repartition(1), trip_rules(), null_verdict)
    clean = lake.read_clean(spark, str(tmp_path / "t"), SILVER_TRIPS)
    rejected = lake.read_quarantine(spark, str(tmp_path / "t"), SILVER_TRIPS)
    assert clean.columns == rejected.columns == SILVER_TRIPS.names
    assert rows.multiset(clean) == rows.multiset(parts.clean.drop("source_month"))
    assert rows.multiset(rejected) == rows.multiset(parts.quarantine.drop("source_month"))
    assert counts["n_read"] == df.count() == 7
    assert counts["n_clean"] == clean.count()
    assert counts["n_quarantined"] == rejected.count()
    assert counts["n_unjudged"] == (1 if null_verdict == "drop" else 0)


def test_gathered_months_make_few_files(spark, tmp_path):
    """Rows of 24 months spread over 16 tasks, two thirds of them in one month."""
    months = [datetime(2021 + i // 12, i % 12 + 1, 5) for i in range(24)] + [MIXED_MONTH] * 48
    changes = [
        {"tpep_pickup_datetime": m, "tpep_dropoff_datetime": datetime(2024, 1, 1)} for m in months
    ]
    df = prepare_trips(rows.trips(spark, *changes)).withColumn(
        "source_month", F.date_format("tpep_pickup_datetime", "yyyy-MM")
    )
    df = df.crossJoin(spark.range(20)).drop("id").repartition(16)
    files, counts, stored = [], [], []
    for gather in (False, True):
        root = tmp_path / str(gather)
        counts.append(lake.write_split(df, trip_rules(), str(root), gather=gather))
        files.append(len(list(root.rglob("*.parquet"))))
        stored.append(rows.multiset(lake.read_clean(spark, str(root), SILVER_TRIPS)))
    assert counts[0] == counts[1] == {
        "n_read": 1440, "n_clean": 1440, "n_quarantined": 0, "n_unjudged": 0,
    }
    assert stored[0] == stored[1]
    assert files[1] <= 30 < 200 < files[0]


def test_gathered_hot_month_is_split(spark, tmp_path):
    path = str(tmp_path / "hot")
    one = F.broadcast(prepare_trips(rows.trips(spark, {})).drop("trip_id"))
    ids = spark.range(0, 60_000, 1, 12).select(F.sha2(F.col("id").cast("string"), 256))
    hot = ids.toDF("trip_id").crossJoin(one)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        lake.write_split(hot, trip_rules(), path, gather=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = [
        r.n
        for r in lake.read_clean(spark, path, SILVER_TRIPS)
        .groupBy("_metadata.file_path")
        .agg(F.count("*").alias("n"))
        .collect()
    ]
    assert sum(sizes) == 60_000
    assert max(sizes) < 60_000 / 3


def test_folders(spark, tmp_path):
    root = tmp_path / "t"
    lake.write_split(mixed(spark), trip_rules(), str(root))
    run = next((root / "data").iterdir())
    months = {p.name for p in (run / "verdict=clean").iterdir()}
    assert months == {"partition_month=2023-01", "partition_month=2023-02"}
    # The clean folder can be read by itself.
    direct = spark.read.parquet(str(run / "verdict=clean"))
    assert dict(direct.dtypes)["partition_month"] == "string"
    assert sorted(direct.columns) == sorted(SILVER_TRIPS.names)
    # Any number of wrong months makes one folder of rejected rows.
    assert len(list((run / "verdict=quarantine").iterdir())) == 1


def test_separate_datasets_hold_the_same(spark, tmp_path):
    df = mixed(spark)
    one, silver, bad = (str(tmp_path / n) for n in ("one", "silver", "bad"))
    lake.write_split(df, trip_rules(), one)
    counts = lake.write_separate(df, trip_rules(), silver, bad)
    assert counts == {"n_clean": 3, "n_quarantined": 3}
    for path, together in (
        (silver, lake.read_clean(spark, one, SILVER_TRIPS)),
        (bad, lake.read_quarantine(spark, one, SILVER_TRIPS)),
    ):
        apart = lake.read_dataset(spark, path, SILVER_TRIPS)
        assert rows.multiset(apart) == rows.multiset(together)
    assert not list(Path(bad).rglob("partition_month=*"))


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrite_is_of_the_whole(spark, tmp_path, mode):
    root = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        lake.write_split(mixed(spark), trip_rules(), root)
        january = mixed(spark).filter(F.col("source_month") == "2023-01")
        lake.write_split(january, trip_rules(), root)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    clean = lake.read_clean(spark, root, SILVER_TRIPS)
    assert {r.partition_month for r in clean.collect()} == {"2023-01"}


def test_only_named_months_are_replaced(spark, tmp_path):
    root = str(tmp_path / "t")
    lake.write_split(mixed(spark), trip_rules(), root)
    # January comes again without a faulty row, and February is not touched.
    again = mixed(spark).filter((F.col("fare_amount") > 0) & F.col("tpep_pickup_datetime").isNotNull())
    counts = lake.write_split(again, trip_rules(), root, months=["2023-01", "2023-03"])
    assert counts == {"n_read": 2, "n_clean": 2, "n_quarantined": 0, "n_unjudged": 0}
    clean = lake.read_clean(spark, root, SILVER_TRIPS).groupBy("partition_month").count()
    assert sorted(map(tuple, clean.collect())) == [("2023-01", 2), ("2023-02", 1)]
    assert lake.read_quarantine(spark, root, SILVER_TRIPS).count() == 0
    # Then it comes with faulty rows only.
    lake.write_split(mixed(spark).filter("fare_amount <= 0"), trip_rules(), root, months=["2023-01"])
    assert lake.read_clean(spark, root, SILVER_TRIPS).first().partition_month == "2023-02"
    assert lake.read_quarantine(spark, root, SILVER_TRIPS).count() == 2


def test_nothing_to_store(spark, tmp_path):
    root = str(tmp_path / "t")
    counts = lake.write_split(mixed(spark).limit(0), trip_rules(), root)
    assert set(counts.values()) == {0}
    assert lake.read_clean(spark, root, SILVER_TRIPS).count() == 0
    assert lake.read_quarantine(spark, root, SILVER_TRIPS).count() == 0


def test_zones(spark, tmp_path):
    df = rows.zones(spark, (1, "EWR", "Newark", "EWR"), (2, "Queens", " ", "x"), (None, *"abc"))
    counts = lake.write_split(df, zone_rules(), str(tmp_path / "z"))
    assert counts == {"n_read": 3, "n_clean": 1, "n_quarantined": 2, "n_unjudged": 0}
    assert lake.read_clean(spark, str(tmp_path / "z"), ZONES).first().Zone == "Newark"
    assert {r.Zone for r in lake.read_quarantine(spark, str(tmp_path / "z"), ZONES).collect()} == {
        " ",
        "b",
    }
