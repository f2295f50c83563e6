"""Writes that sort their rows read few bytes a task."""

import pytest
import rows
from pyspark.sql import functions as F
from triplake import session
from triplake.functions.trips import prepare_trips
from triplake.operators.quality import trip_rules
from triplake.schemas import RAW_TRIPS, SILVER_TRIPS
from triplake.session import SPLIT_BYTES, byte_size
from triplake.sources import lake, raw


def test_byte_size():
    sizes = {"128MB": 128 << 20, "16m": 16 << 20, "4096": 4096, "134217728b": 128 << 20, "1g": 1 << 30, "8kb": 8192}
    assert {text: byte_size(text) for text in sizes} == sizes


def test_finer_scans_hold_within_only(spark):
    before = spark.conf.get(SPLIT_BYTES)
    with pytest.raises(ValueError), session.sortable_scans(spark):
        assert byte_size(spark.conf.get(SPLIT_BYTES)) == session.SORTED_BYTES
        raise ValueError
    assert spark.conf.get(SPLIT_BYTES) == before
    try:
        spark.conf.set(SPLIT_BYTES, "1m")
        with session.sortable_scans(spark):
            assert spark.conf.get(SPLIT_BYTES) == "1m"
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def test_sorted_writes_read_few_bytes_a_task(spark, tmp_path, database, monkeypatch):
    """Files that one task would have read and sorted are written by several."""
    made = rows.trips(spark, *[{"fare_amount": float(i)} for i in range(1, 41)])
    for i in range(8):
        made.repartition(1).write.parquet(str(tmp_path / f"in/{i}"))
    size = sum(f.stat().st_size for f in tmp_path.glob("in/*/*.parquet"))
    monkeypatch.setattr(session, "SORTED_BYTES", size // 4)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        stored = spark.read.schema(made.schema).parquet(*(str(tmp_path / f"in/{i}") for i in range(8)))
        assert stored.rdd.getNumPartitions() == 1
        lake.write_split(prepare_trips(stored), trip_rules(), str(tmp_path / "t"))
        clean = lake.read_clean(spark, str(tmp_path / "t"), SILVER_TRIPS)
        assert clean.select(F.input_file_name()).distinct().count() >= 4
        assert clean.count() == 320
        raw.create_tables(spark, *database)
        monkeypatch.setattr(session, "SORTED_BYTES", 1 << 13)
        assert raw.append_trips(clean, database[0]) == 320
        loaded = raw.read_table(spark, database[0], raw.TRIPS_TABLE)
        assert loaded.select(F.input_file_name()).distinct().count() >= 4
        assert loaded.select(*RAW_TRIPS.names).count() == 320
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
