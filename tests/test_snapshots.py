import os
import threading

import pytest
import rows
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from test_lake import mixed
from triplake.operators.quality import trip_rules
from triplake.schemas import SILVER_TRIPS
from triplake.sources import lake, snapshots
from triplake.sources.objects import put_if_absent, read_text
from triplake.sources.snapshots import CommitLog

SCHEMA = StructType([StructField("id", LongType()), StructField("m", StringType())])


def numbers(spark, n, months=3):
    return spark.range(n).withColumn("m", F.concat(F.lit("0"), F.col("id") % months))


def by_month(df):
    return dict(map(tuple, df.groupBy("m").count().collect()))


def test_a_version_is_the_whole_dataset(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.latest() == snapshots.EMPTY and log.read(SCHEMA).count() == 0
    first = log.write(numbers(spark, 30), "m")
    assert first.version == 1 and by_month(log.read(SCHEMA)) == {"00": 10, "01": 10, "02": 10}
    assert len(first.folders()) == 1
    second = log.write(numbers(spark, 4, 1), "m", replaced=lambda part: part == "m=00")
    assert by_month(log.read(SCHEMA)) == {"00": 4, "01": 10, "02": 10}
    # Two parts of the first run and all of the second.
    assert len(second.folders()) == 3
    assert by_month(log.read(SCHEMA, first)) == {"00": 10, "01": 10, "02": 10}
    assert by_month(log.read(SCHEMA, wanted=lambda part: part != "m=01")) == {"00": 4, "02": 10}
    log.write(numbers(spark, 0), "m")
    assert log.read(SCHEMA).count() == 0 and log.latest().version == 3


def test_parts_of_several_runs(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    for _ in range(2):
        log.write(numbers(spark, 3), "m", replaced=lambda part: False)
    assert by_month(log.read(SCHEMA)) == {"00": 2, "01": 2, "02": 2}
    log.write(numbers(spark, 1, 1), "m", replaced=lambda part: part == "m=00")
    assert by_month(log.read(SCHEMA)) == {"00": 1, "01": 2, "02": 2}


def test_a_write_that_fails_half_way_leaves_all_rows(spark, tmp_path):
    root, rules = str(tmp_path / "t"), trip_rules()
    lake.write_split(mixed(spark), rules, root)
    before = rows.multiset(lake.read_clean(spark, root, SILVER_TRIPS))
    many = mixed(spark).crossJoin(spark.range(0, 40, 1, 4))
    dies = F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.col("fare_amount"))
    broken = many.withColumn("fare_amount", dies).drop("id")
    for months in (None, ["2023-01"]):
        with pytest.raises(Exception, match="lost"):
            lake.write_split(broken, rules, root, months=months)
        assert rows.multiset(lake.read_clean(spark, root, SILVER_TRIPS)) == before
    assert lake.read_quarantine(spark, root, SILVER_TRIPS).count() == 3


def test_readers_keep_to_their_snapshot(spark, tmp_path):
    root = str(tmp_path / "t")
    lake.write_split(mixed(spark), trip_rules(), root)
    clean = lake.read_clean(spark, root, SILVER_TRIPS)
    before = rows.multiset(clean)
    lake.write_split(mixed(spark).limit(0), trip_rules(), root)
    assert rows.multiset(clean) == before
    assert lake.read_clean(spark, root, SILVER_TRIPS).count() == 0
    first = CommitLog(spark, root).at(1)
    assert rows.multiset(lake.read_clean(spark, root, SILVER_TRIPS, first)) == before


def test_nothing_committed_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        lake.read_clean(spark, str(tmp_path), SILVER_TRIPS)
    with pytest.raises(FileNotFoundError):
        lake.read_dataset(spark, str(tmp_path), SILVER_TRIPS)


def test_only_one_writer_gets_a_number(spark, tmp_path):
    path, won = str(tmp_path / "_log" / "1.json"), []

    def put(i):
        if put_if_absent(spark, path, f"[{i}]"):
            won.append(i)

    threads = [threading.Thread(target=put, args=(i,)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and read_text(spark, path) == f"[{won[0]}]"
    assert len(os.listdir(tmp_path / "_log")) <= 2  # the entry, and its checksum at most


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    def add(i):
        log = CommitLog(spark, str(tmp_path))
        log.commit({f"_run=00{i}-x": [f"m={i}"]})

    threads = [threading.Thread(target=add, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    latest = CommitLog(spark, str(tmp_path)).latest()
    assert latest.version == 8 and sorted(latest.parts) == [f"m={i}" for i in range(8)]


def test_an_entry_without_an_end_is_passed_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "TORN_AFTER", 0.2)
    log = CommitLog(spark, str(tmp_path))
    log.write(numbers(spark, 3), "m")
    (tmp_path / "_log" / f"{2:020d}.json").write_text('{"parts": {"m=0')
    assert log.latest().version == 1 and log.read(SCHEMA).count() == 3
    assert log.write(numbers(spark, 6), "m").version == 3
    # The writer that was given up finds out, and commits again.
    assert not log._followed(2) and log._followed(3)


def test_vacuum_keeps_what_is_named_or_young(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    for n in range(1, 11):
        log.write(numbers(spark, n), "m")
    assert log.vacuum(keep=3) == [f"_log/{n:020d}.json" for n in range(1, 8)]
    assert len(log.vacuum(keep=3, grace_seconds=0)) == 7
    assert len(list((tmp_path / "data").iterdir())) == 3 and log.versions() == [8, 9, 10]
    assert [log.read(SCHEMA, log.at(v)).count() for v in log.versions()] == [8, 9, 10]
    assert log.write(numbers(spark, 2), "m").version == 11
