"""Quality rules as data, and the three-way split they give.

A row is bad when any rule holds. SQL logic has three values: where no rule
holds but one is unknown, the row is neither clean nor bad. Such rows are
counted as unjudged and leave both outputs, or go to quarantine, by choice.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICT = "verdict"
CLEAN = "clean"
QUARANTINE = "quarantine"

# What becomes of unjudged rows.
NULL_VERDICTS = ("drop", "quarantine")

# Fixed value: largest passenger count that is believed.
MAX_PASSENGERS = 9


class Rule(NamedTuple):
    """A named fault; ``broken`` is true on rows that have it."""

    name: str
    broken: Column


class Split(NamedTuple):
    clean: DataFrame
    quarantine: DataFrame
    unjudged: DataFrame


def trip_rules() -> list[Rule]:
    """Faults of a prepared trip. Distance and fare may be NULL: see above."""
    passengers = F.col("passenger_count")
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return [
        Rule("passenger_null", passengers.isNull()),
        Rule("passenger_le_0", passengers <= 0),
        Rule("passenger_gt_9", passengers > MAX_PASSENGERS),
        Rule("distance_le_0", F.col("trip_distance") <= 0),
        Rule("fare_le_0", F.col("fare_amount") <= 0),
        Rule("pickup_null", pickup.isNull()),
        Rule("dropoff_null", dropoff.isNull()),
        Rule("pickup_ge_dropoff", pickup >= dropoff),
        Rule("wrong_month", F.col("partition_month") != F.col("source_month")),
    ]


def zone_rules() -> list[Rule]:
    location = F.col("LocationID")
    rules = [
        Rule("location_null", location.isNull()),
        Rule("location_le_0", location <= 0),
    ]
    for name in ("Borough", "Zone", "service_zone"):
        rules.append(Rule(f"{name.lower()}_null", F.col(name).isNull()))
        rules.append(Rule(f"{name.lower()}_blank", F.trim(F.col(name)) == ""))
    return rules


def is_bad(rules: list[Rule]) -> Column:
    return reduce(or_, (rule.broken for rule in rules))


def split(df: DataFrame, rules: list[Rule], null_verdict: str = "drop") -> Split:
    """Clean, quarantined and unjudged rows; their sizes add up to the input's."""
    _check(null_verdict)
    bad = is_bad(rules)
    if null_verdict == "quarantine":
        bad = F.coalesce(bad, F.lit(True))
    return Split(df.filter(~bad), df.filter(bad), df.filter(bad.isNull()))


def judge(df: DataFrame, rules: list[Rule], null_verdict: str = "drop") -> DataFrame:
    """``df`` with a verdict column; NULL on unjudged rows."""
    _check(null_verdict)
    bad = is_bad(rules)
    unknown = F.lit(QUARANTINE if null_verdict == "quarantine" else None).cast("string")
    verdict = F.when(bad, QUARANTINE).when(bad.isNull(), unknown).otherwise(CLEAN)
    return df.select("*", verdict.alias(VERDICT))


def audit_columns(verdict: Column) -> list[Column]:
    """Row counts by verdict, usable in ``agg`` and in ``observe``."""
    return [
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(verdict == CLEAN).alias("n_clean"),
        F.count_if(verdict == QUARANTINE).alias("n_quarantined"),
        F.count_if(verdict.isNull()).alias("n_unjudged"),
    ]


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: how many input rows break each rule."""
    return df.agg(*(F.count_if(rule.broken).alias(rule.name) for rule in rules))


def _check(null_verdict: str) -> None:
    if null_verdict not in NULL_VERDICTS:
        raise ValueError(f"null_verdict must be one of {NULL_VERDICTS}: {null_verdict}")
