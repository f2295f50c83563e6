"""Every query gives what its SQL gives in another engine on the same tables."""

import os
from pathlib import Path

import __spark_entry__ as driver
import oracle
import pytest
from pyspark.sql import functions as F
from triplake.oracles import ORACLES
from triplake.queries import QUERIES
from triplake.fixtures import trips_drifted, trips_source, zones_source

SF_DIR = os.environ.get("TRIPLAKE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="tables not here")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert oracle.difference(df, duck, driver.oracle_sql()[name]) == ""


def test_deliveries_are_joined_once(spark):
    """Three drifted deliveries come from one stored join, not from a join each."""
    parts = trips_drifted(spark, SF_DIR)
    assert [df.count() > 0 for df in parts] == [True] * 3
    for df in parts:
        assert {Path(f).parent.parent.name.split("-")[1] for f in df.inputFiles()} == {"deliveries"}


def test_entry(spark):
    rows = {r.borough: (r.trip_count, r.total_revenue) for r in driver.entry(spark).collect()}
    assert len(rows) == 6
    assert rows[""] == (161, 8201536.29)
    assert rows["EUROPE"] == (508, 26323391.83)


def test_tables_hold_every_kind_of_fault(spark):
    """The checks above mean something only if each rule finds rows."""
    found = driver.queries()["trips_rule_counts"](spark, SF_DIR).first().asDict()
    assert all(n > 0 for n in found.values()), found
    assert trips_source(spark, SF_DIR).filter(F.col("trip_distance").isNull()).count() > 0
    assert zones_source(spark, SF_DIR).count() == 25
