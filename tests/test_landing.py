import hashlib
from pathlib import Path

import pytest
import rows
from pyspark.sql import functions as F
from triplake.sources import bronze, footers, landing, manifest

ZONES_CSV = "taxi_zone_lookup.csv"


def wanted(spark, *pairs):
    return spark.createDataFrame(
        [(name, str(path)) for name, path in pairs], "object_name string, source_path string"
    )


@pytest.fixture
def delivered(spark, tmp_path):
    """Two months and a zone lookup, as a source delivers them."""
    source = tmp_path / "source"
    names = [f"yellow_tripdata_2023-0{m}.parquet" for m in (1, 2)]
    for name in names:
        df = rows.trips(spark, {}, {"extra": 2.0}).drop("source_month")
        df.write.parquet(str(source / name))
    lines = "LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n2,Queens,,x\n"
    (source / ZONES_CSV).write_text(lines)
    return wanted(spark, *((n, source / n) for n in (*names, ZONES_CSV)))


def stored(spark, target, name):
    """Where a landed object lies."""
    return manifest.stored_path(spark, f"{target}/{name}")


def names_of(df):
    return sorted(r.object_name for r in df.collect())


def test_lands_what_is_missing_only(spark, delivered, tmp_path):
    target = str(tmp_path / "bronze")
    first = landing.land(spark, delivered.limit(1), target)
    second = landing.land(spark, delivered, target)
    assert sorted(names_of(first) + names_of(second)) == names_of(delivered)
    assert landing.land(spark, delivered, target).count() == 0
    assert names_of(landing.land(spark, delivered, target, force=True)) == names_of(delivered)
    trips = bronze.read_bronze_trips(spark, f"{target}/*.parquet")
    assert trips.groupBy("source_month").count().collect()[0][1] == 2
    zones = bronze.read_zones_csv(spark, f"{target}/{ZONES_CSV}")
    assert sorted(r.LocationID for r in zones.collect()) == [1, 2]


def test_a_run_without_its_entry_is_not_there(spark, delivered, tmp_path, monkeypatch):
    """A landing that is lost after its rows were written, before its entry."""
    target, tables = str(tmp_path / "bronze"), delivered.filter("object_name like 'yellow%'")
    landing.land(spark, tables.filter("object_name like '%01.parquet'"), target)

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(landing, "_commit", lost)
    with pytest.raises(OSError, match="lost"):
        landing.land(spark, tables, target, force=True)
    monkeypatch.undo()
    assert len(list((tmp_path / "bronze" / "_landed" / "data").iterdir())) == 2
    assert names_of(landing.landed_objects(spark, target)) == ["yellow_tripdata_2023-01.parquet"]
    assert bronze.read_bronze_trips(spark, f"{target}/*.parquet").count() == 2
    assert names_of(landing.land(spark, tables, target)) == ["yellow_tripdata_2023-02.parquet"]
    assert bronze.read_bronze_trips(spark, f"{target}/*.parquet").count() == 4


def test_plain_objects_lie_beside_landed_ones(spark, delivered, tmp_path):
    """Both kinds are read; of one name the landed one counts."""
    target = tmp_path / "bronze"
    landing.land(spark, delivered, str(target))
    for name in ("yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-03.parquet"):
        rows.trips(spark, *[{}] * 5).drop("source_month").write.parquet(str(target / name))
    found = bronze.read_bronze_trips(spark, f"{target}/*.parquet").groupBy("source_month").count()
    assert sorted(map(tuple, found.collect())) == [("2023-01", 2), ("2023-02", 2), ("2023-03", 5)]
    assert names_of(landing.landed_objects(spark, str(target))) == sorted(
        [*names_of(delivered), "yellow_tripdata_2023-03.parquet"]
    )


def test_objects_of_months(spark):
    df = landing.monthly_objects(spark, "s3a://source/", ["2023-01"], [ZONES_CSV])
    assert [tuple(r) for r in df.collect()] == [
        ("yellow_tripdata_2023-01.parquet", "s3a://source/yellow_tripdata_2023-01.parquet"),
        (ZONES_CSV, f"s3a://source/{ZONES_CSV}"),
    ]


def test_single_file_counts_as_landed(spark, delivered, tmp_path):
    target = tmp_path / "bronze"
    target.mkdir()
    (target / ZONES_CSV).write_text("LocationID\n")
    assert ZONES_CSV not in names_of(landing.land(spark, delivered, str(target)))


def test_audit_finds_changed_content(spark, delivered, tmp_path):
    target = str(tmp_path / "bronze")
    audit = landing.land(spark, delivered, target)
    assert landing.verify_landed(spark, audit, target) == []
    name = "yellow_tripdata_2023-02.parquet"
    changed = rows.trips(spark, {}, {"extra": 2.5}).drop("source_month")
    changed.write.mode("overwrite").parquet(stored(spark, target, name))
    assert landing.verify_landed(spark, audit, target) == [name]


def test_fingerprint(spark):
    def of(df):
        return tuple(df.agg(*landing.fingerprint_columns(df.columns)).first())

    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    assert of(df) == of(df.orderBy(F.desc("id")).repartition(3))
    # Copies count: the same rows twice are another content.
    assert of(df) != of(df.union(df))
    assert of(df) != of(df.withColumn("v", F.col("id") % 5))


@pytest.mark.parametrize("block", ["60b", "100b", "1k"])
def test_large_text_object_keeps_one_header(spark, tmp_path, block):
    """Read in many blocks, the object is stored in many files, all with a header."""
    lines = [f"{i},Borough {i},Zone {i},service" for i in range(1, 200)]
    # A line that looks like the header is data.
    header = "LocationID,Borough,Zone,service_zone"
    lines.insert(100, header)
    source = tmp_path / ZONES_CSV
    source.write_text("\n".join([header, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        target = str(tmp_path / "bronze")
        landing.land(spark, wanted(spark, (ZONES_CSV, source)), target)
        files = list(Path(stored(spark, target, ZONES_CSV)).glob("part-*"))
        assert len(files) > 1
        found = bronze.read_zones_csv(spark, f"{target}/{ZONES_CSV}").collect()
        direct = bronze.read_zones_csv(spark, str(source)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted(map(repr, found)) == sorted(map(repr, direct))
    assert len(found) == 200


def test_text_in_another_encoding(spark, tmp_path):
    source = tmp_path / ZONES_CSV
    source.write_bytes("LocationID,Borough,Zone,service_zone\n1, Año ,\"a, b\",x\n2,c\n".encode("latin-1"))
    target = str(tmp_path / "bronze")
    audit = landing.land(spark, wanted(spark, (ZONES_CSV, source)), target, encoding="ISO-8859-1")
    assert [(r.n_rows, r.verified) for r in audit.collect()] == [(2, True)]
    found = bronze.read_zones_csv(spark, f"{target}/{ZONES_CSV}").collect()
    assert sorted(tuple(r) for r in found) == [(1, " Año ", "a, b", "x"), (2, "c", None, None)]
    assert landing.verify_landed(spark, landing.kept_audit(spark, target), target) == []


def test_parts_with_other_headers_are_refused(spark, tmp_path):
    source = tmp_path / ZONES_CSV
    source.mkdir()
    (source / "part-0.csv").write_text("LocationID,Borough\n1,a\n")
    (source / "part-1.csv").write_text("Borough,LocationID\nb,2\n")
    with pytest.raises(Exception, match="header"):
        landing.land(spark, wanted(spark, (ZONES_CSV, source)), str(tmp_path / "bronze"))


@pytest.mark.parametrize("lines", ["", "LocationID,Borough,Zone,service_zone\n"])
def test_text_object_without_rows(spark, tmp_path, lines):
    source, target = tmp_path / ZONES_CSV, str(tmp_path / "bronze")
    source.write_text(lines)
    audit = landing.land(spark, wanted(spark, (ZONES_CSV, source)), target).first()
    assert (audit.n_rows, audit.verified) == (0, True)
    assert bronze.read_zones_csv(spark, f"{target}/{ZONES_CSV}").count() == 0


def test_newest_audit_is_kept(spark, delivered, tmp_path):
    target = str(tmp_path / "bronze")
    landing.land(spark, delivered, target)
    landing.land(spark, delivered, target, force=True)
    kept = landing.kept_audit(spark, target)
    assert names_of(kept) == names_of(delivered)
    assert all(r.verified for r in kept.collect())
    assert landing.MANIFEST not in names_of(landing.landed_objects(spark, target))


def test_schemas_are_read_once(spark, delivered, tmp_path, monkeypatch):
    target = str(tmp_path / "bronze")
    audit = landing.land(spark, delivered, target)
    asked = []
    merged = bronze.merged_parts
    monkeypatch.setattr(bronze, "merged_parts", lambda s, path: asked.append(path) or merged(s, path))
    assert bronze.read_bronze_trips(spark, f"{target}/*.parquet").count() == 4
    assert landing.verify_landed(spark, audit, target) == []
    assert asked == []
    # Plain objects are not in the record, and one of them stands for all that are alike.
    for month in (3, 4, 5):
        wider = rows.trips(spark, {}).withColumn("VendorID", F.lit("x")).drop("source_month")
        wider.write.parquet(f"{target}/yellow_tripdata_2023-0{month}.parquet")
    assert bronze.read_bronze_trips(spark, f"{target}/*.parquet").count() == 7
    assert [path.rsplit("/", 1)[-1] for path in asked] == ["yellow_tripdata_2023-03.parquet"]


def test_objects_of_one_schema_are_landed_together(spark, tmp_path):
    """Other names, odd names, an object without rows and one of several parts."""
    source, target = tmp_path / "source", str(tmp_path / "bronze")
    frames = {
        "a.parquet": rows.trips(spark, {}, {}),
        "b'=b.parquet": rows.trips(spark, {}),
        "c c%.parquet": rows.trips(spark, {}, {}, {}),
        "none.parquet": rows.trips(spark),
        "parts.parquet": rows.trips(spark, *[{}] * 8).repartition(4),
    }
    for name, df in frames.items():
        df.drop("source_month").write.parquet(str(source / name))
    pairs = [(name, source / name) for name in frames] + [("renamed.parquet", source / "a.parquet")]
    for force in (False, True):
        audit = landing.land(spark, wanted(spark, *pairs), target, force)
        assert {r.object_name: (r.n_rows, r.verified) for r in audit.collect()} == {
            "a.parquet": (2, True), "b'=b.parquet": (1, True), "c c%.parquet": (3, True),
            "none.parquet": (0, True), "parts.parquet": (8, True), "renamed.parquet": (2, True),
        }
    assert names_of(landing.landed_objects(spark, target)) == sorted(n for n, _ in pairs)
    assert landing.verify_landed(spark, landing.kept_audit(spark, target), target) == []
    assert bronze.read_bronze_trips(spark, f"{target}/*.parquet").count() == 16


def plain_digest(data, block, fan):
    nodes = [hashlib.sha256(data[i : i + block]).hexdigest() for i in range(0, max(len(data), 1), block)]
    while len(nodes) > 1:
        joined = ("".join(nodes[i : i + fan]) for i in range(0, len(nodes), fan))
        nodes = [hashlib.sha256(j.encode()).hexdigest() for j in joined]
    return nodes[0]


def test_digests_of_bytes(spark, tmp_path):
    """Files of all sizes around blocks and ranges, in folders or not, and odd names."""
    sizes = [1, 9, 10, 11, 30, 31, 90, 91, 1000]
    (tmp_path / "many").mkdir()
    for n in sizes:
        (tmp_path / "many" / f"part {n}%.bin").write_bytes(bytes(i % 251 for i in range(n)))
    (tmp_path / "one.csv").write_bytes(b"a,b\r\n" * 50)
    objects = bronze.glob_objects(spark, f"{tmp_path}/*")
    found = []
    for range_bytes in (10, 30, 100, 10_000):
        rows = footers.file_digests(spark, objects, range_bytes, block=10, fan=3).collect()
        found.append(sorted((r.path.rsplit("/", 1)[-1], r.n_bytes, r.digest) for r in rows))
    files = [*(tmp_path / "many").iterdir(), tmp_path / "one.csv"]
    expected = sorted((f.name, f.stat().st_size, plain_digest(f.read_bytes(), 10, 3)) for f in files)
    assert found == [expected] * 4
    with pytest.raises(ValueError, match="whole blocks"):
        footers.file_digests(spark, objects, 15, block=10)


def test_audit_has_size_and_digest_of_what_was_delivered(spark, delivered, tmp_path):
    audit = {r.object_name: r for r in landing.land(spark, delivered, str(tmp_path / "b"), digests=True).collect()}
    source = tmp_path / "source"
    for name, row in audit.items():
        at = source / name
        files = [at] if at.is_file() else sorted(f for f in at.iterdir() if f.name.startswith("part-"))
        lines = [f"{f.name} {hashlib.sha256(f.read_bytes()).hexdigest()}" for f in files]
        assert row.n_bytes == sum(f.stat().st_size for f in files)
        assert row.digest == hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()
    assert {r.digest for r in landing.kept_audit(spark, str(tmp_path / "b")).collect()} == {
        r.digest for r in audit.values()
    }


def test_paths_that_tasks_can_open():
    assert footers._split("file:/a b/c:d") == ("file", "", "/a b/c:d")
    assert footers._split("file:///a") == ("file", "", "/a")
    assert footers._split("/a:b/c") == ("file", "", "/a:b/c")
    assert footers._split("s3a://bucket/a/b") == ("s3a", "bucket", "/a/b")
    assert footers.reachable("s3a://b/c") and not footers.reachable("viewfs://x/y")
