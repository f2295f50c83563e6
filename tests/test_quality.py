from datetime import datetime

import pytest
import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from triplake.functions.trips import prepare_trips
from triplake.operators import quality as Q

PICKUP = rows.GOOD_TRIP["tpep_pickup_datetime"]
FAULTS = {
    "passenger_null": {"passenger_count": None},
    "passenger_le_0": {"passenger_count": 0.0},
    "passenger_gt_9": {"passenger_count": 10.0},
    "distance_le_0": {"trip_distance": 0.0},
    "fare_le_0": {"fare_amount": -1.0},
    "pickup_null": {"tpep_pickup_datetime": None},
    "dropoff_null": {"tpep_dropoff_datetime": None},
    "pickup_ge_dropoff": {"tpep_dropoff_datetime": PICKUP},
    "wrong_month": {
        "tpep_pickup_datetime": datetime(2022, 12, 31, 23, 59),
    },
}


def test_each_fault_breaks_its_rule_only(spark):
    rules = Q.trip_rules()
    assert [r.name for r in rules] == list(FAULTS)
    for name, change in FAULTS.items():
        counts = Q.rule_counts(prepare_trips(rows.trips(spark, change)), rules).first()
        assert {k for k, n in counts.asDict().items() if n} == {name}


def test_bounds_are_clean(spark):
    df = rows.trips(spark, {}, {"passenger_count": 1.0}, {"passenger_count": 9.0})
    assert Q.split(prepare_trips(df), Q.trip_rules()).clean.count() == 3


def test_nan_distance_is_clean(spark):
    df = prepare_trips(rows.trips(spark, {"trip_distance": float("nan")}))
    assert Q.split(df, Q.trip_rules()).clean.count() == 1


def test_misnamed_object_fails_every_row(spark):
    df = prepare_trips(rows.trips(spark, {}, {}, month="other_2023-01"))
    assert Q.split(df, Q.trip_rules()).quarantine.count() == 2


@pytest.mark.parametrize("column", ["trip_distance", "fare_amount"])
def test_unknown_verdict(spark, column):
    df = prepare_trips(rows.trips(spark, {column: None}))
    parts = Q.split(df, Q.trip_rules())
    assert [p.count() for p in parts] == [0, 0, 1]
    assert [p.count() for p in Q.split(df, Q.trip_rules(), "quarantine")] == [0, 1, 0]
    # Another fault decides, whatever is unknown.
    df = prepare_trips(rows.trips(spark, {column: None, "passenger_count": 0.0}))
    assert [p.count() for p in Q.split(df, Q.trip_rules())] == [0, 1, 0]


def test_zone_rules(spark):
    good = (4, "Queens", "Astoria", "Boro Zone")
    bad = [
        (None, "Queens", "Astoria", "Boro Zone"),
        (0, "Queens", "Astoria", "Boro Zone"),
        (5, None, "Astoria", "Boro Zone"),
        (6, "  ", "Astoria", "Boro Zone"),
        (7, "Queens", "", "Boro Zone"),
        (8, "Queens", "Astoria", None),
    ]
    known = [(264, "Unknown", "N/A", "N/A"), (9, "\t", "Astoria", "Boro Zone")]
    parts = Q.split(rows.zones(spark, good, *bad, *known), Q.zone_rules())
    assert [p.count() for p in parts] == [3, 6, 0]


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError, match="null_verdict"):
        Q.split(rows.zones(spark), Q.zone_rules(), "keep")


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "passenger_count": st.sampled_from([None, -1.0, 0.0, 0.5, 1.0, 9.9, 10.0]),
                "trip_distance": st.sampled_from([None, -1.0, 0.0, 2.0]),
                "fare_amount": st.sampled_from([None, -1.0, 0.0, 2.0]),
                "tpep_pickup_datetime": st.sampled_from([None, PICKUP, datetime(2023, 2, 1)]),
            }
        ),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from(Q.NULL_VERDICTS),
)
def test_parts_add_up(spark, changes, null_verdict):
    """No row is lost or told twice, and the verdicts say what the split does."""
    df = prepare_trips(rows.trips(spark, *changes))
    parts = Q.split(df, Q.trip_rules(), null_verdict)
    together = parts.clean.unionAll(parts.quarantine).unionAll(parts.unjudged)
    assert rows.multiset(together) == rows.multiset(df)
    judged = Q.judge(df, Q.trip_rules(), null_verdict)
    audit = judged.agg(*Q.audit_columns(F.col("verdict"))).first()
    assert tuple(audit) == (len(changes), *(p.count() for p in parts))
