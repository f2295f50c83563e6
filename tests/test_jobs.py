import importlib.util
from pathlib import Path

import pytest
from test_refresh import EXPECTED, deliver
from triplake.sources import raw

JOB = Path(__file__).resolve().parents[1] / "jobs" / "lakehouse.py"


@pytest.fixture(scope="module")
def job():
    spec = importlib.util.spec_from_file_location("lakehouse_job", JOB)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture
def places(tmp_path, database):
    name, location = database
    return [
        "--bronze", str(tmp_path / "bronze"), "--root", str(tmp_path / "lake"),
        "--database", name, "--database-location", location,
    ]


def test_stages_one_by_one(spark, tmp_path, job, places):
    deliver(spark, tmp_path / "bronze")
    assert job.run(spark, ["clean-trips", *places]) == EXPECTED["trips"]
    assert job.run(spark, ["clean-zones", *places]) == EXPECTED["zones"]
    assert job.run(spark, ["load-raw", *places, "--files", "2"]) == EXPECTED["raw"]
    assert job.run(spark, ["models", *places]) == {"boroughs": 1}
    assert job.run(spark, ["refresh", *places]) == EXPECTED


def test_land_by_month(spark, tmp_path, job, places):
    source = tmp_path / "source"
    source.mkdir()
    deliver(spark, source)
    wanted = ["--source", str(source), "--months", "2023-01,2023-02,2023-03"]
    with pytest.raises(SystemExit):
        job.run(spark, ["land", *places])
    landed = job.run(spark, ["land", *places, *wanted])
    # Rows, so the header line of the zones does not count.
    assert sum(landed.values()) == 6 + 3
    assert job.run(spark, ["land", *places, *wanted]) == {}
    assert job.run(spark, ["land", *places, *wanted, "--force"]) == landed
    assert job.run(spark, ["refresh", *places, *wanted]) == {"landed": {}, **EXPECTED}


def test_jdbc_targets(spark, tmp_path, job, places, monkeypatch):
    deliver(spark, tmp_path / "bronze")
    for stage in ("clean-trips", "clean-zones"):
        job.run(spark, [stage, *places])
    written = []

    def keep(silver, schema, options, refresh, on_null):
        rows = raw.to_contract(silver, schema, on_null).count()
        written.append((options, refresh, rows))

    monkeypatch.setattr(job, "write_jdbc", keep)
    spark.conf.set(job.JDBC_PASSWORD, "secret")
    options = ["--jdbc-option", "url=jdbc:none:lake", "--jdbc-option", "user=u", "--truncate"]
    try:
        job.run(spark, ["load-jdbc", *places, *options])
    finally:
        spark.conf.unset(job.JDBC_PASSWORD)
    common = {"url": "jdbc:none:lake", "user": "u", "password": "secret"}
    assert written == [
        (common | {"dbtable": "raw_trips"}, True, 2),
        (common | {"dbtable": "raw_zones"}, True, 2),
    ]
