"""What writes shuffle, and how often they make what they store."""

import pytest
import rows
from pyspark.sql import functions as F
from test_lake import mixed
from triplake import fixtures, queries
from triplake.functions.trips import TRIP_DERIVED, TRIP_KEY_PARTS
from triplake.operators.quality import trip_rules
from triplake.schemas import NARROWED, SILVER_TRIPS
from triplake.sources import lake


def test_key_is_made_behind_the_shuffle(spark, tmp_path, monkeypatch):
    assert not set(TRIP_KEY_PARTS) & set(NARROWED)
    shuffled, real = [], lake.gathered
    monkeypatch.setattr(lake, "gathered", lambda df, *by: shuffled.append(df.columns) or real(df, *by))
    df = mixed(spark)
    lake.write_split(df, trip_rules(), str(tmp_path / "keyed"), gather=True)
    lake.write_split(df.drop("trip_id"), trip_rules(), str(tmp_path / "late"), gather=True, derived=TRIP_DERIVED)
    paths = str(tmp_path / "a"), str(tmp_path / "b")
    lake.write_separate(df.drop("trip_id"), trip_rules(), *paths, gather=True, derived=TRIP_DERIVED)
    assert ["trip_id" in columns for columns in shuffled] == [True, False, False]
    for read, apart in ((lake.read_clean, paths[0]), (lake.read_quarantine, paths[1])):
        keyed, late = (rows.multiset(read(spark, str(tmp_path / name), SILVER_TRIPS)) for name in ("keyed", "late"))
        assert keyed == late == rows.multiset(lake.read_dataset(spark, apart, SILVER_TRIPS))


@pytest.mark.parametrize("query", ["silver_snapshot_read", "silver_month_rewritten", "refresh_one_month"])
def test_trips_are_joined_once(spark, tmp_path, monkeypatch, query):
    joined, named = [], F.concat(F.lit("yellow_tripdata_"), "source_month", F.lit(".parquet"))

    def source(spark, sf_dir):
        made = [{"VendorID": i} for i in (1, 3, 5, 7)]
        trips = rows.trips(spark, *made, month=queries.PRUNED_MONTH).withColumn("file_name", named)
        count = spark.sparkContext.accumulator(0)
        joined.append(count)

        def counted(batches):
            for batch in batches:
                count.add(batch.num_rows)
                yield batch

        return trips.drop("source_month").mapInArrow(counted, trips.drop("source_month").schema)

    monkeypatch.setattr(fixtures, "trips_source", source)
    monkeypatch.setattr(fixtures, "zones_source", lambda spark, _: rows.zones(spark, (7, "Queens", "Astoria", "Boro")))
    queries.QUERIES[query](spark, str(tmp_path)).collect()
    assert sum(count.value for count in joined) == 4


def test_objects_delivered_again(spark, tmp_path):
    trips = rows.trips(spark, {"VendorID": 1}, {"VendorID": 5}).withColumn("file_name", F.lit("a.parquet"))
    folder = str(tmp_path / "bronze")
    fixtures.deliver_trips(spark, trips, folder)
    for name, n in (("a.parquet", 1), ("b.parquet", 0)):
        fixtures.deliver_again(spark, folder, name, trips.schema, F.col("VendorID") <= 3)
        again = spark.read.parquet(f"{folder}/{name}")
        assert again.columns == trips.drop("file_name").columns and again.count() == n
