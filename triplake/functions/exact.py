"""Sums of doubles that do not depend on the order of rows.

A double is a whole number of 53 bits times a power of two. It is cut into three limbs of
32 bits at places that are multiples of 32 bits; limbs of one place are added as whole
numbers, so partial sums of any rows, in any order, over any number of tasks or months,
come to the same. Only the end rounds, once, to the nearest double.

Rows are added by built-in functions and partial aggregation; what is left is a few rows
for each group, and one value of a group is put together in Python, whose whole numbers
have no bound.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

LIMB = 32
PLACE, COUNT, SPECIAL = "place", "n", "special"
LIMBS = ("limb_0", "limb_1", "limb_2")
# What NaN and infinities add up to, as text; NULL for numbers.
NAN, PLUS, MINUS = "nan", "inf", "-inf"
# Doubles below this are moved up by whole limbs first, so that no power is a subnormal.
SMALL, SHIFT = 2.0**-400, 512
WHOLE = "decimal(38,0)"


def _limbs(x: Column) -> tuple[Column, list[Column]]:
    """The place of the lowest limb, and three limbs from there; exact for finite x."""
    small = F.abs(x) < SMALL
    moved = F.when(small, x * F.lit(2.0**SHIFT)).otherwise(x)
    # One place too high or too low does not matter: the limbs have room for it.
    top = F.floor(F.log2(F.greatest(F.abs(moved), F.lit(2.0**-640))) / LIMB).cast("int")
    unit = [F.pow(F.lit(2.0), ((top - k) * LIMB).cast("double")) for k in range(3)]
    high = (moved / unit[0]).cast("long")
    rest = moved - high * unit[0]
    middle = (rest / unit[1]).cast("long")
    low = ((rest - middle * unit[1]) / unit[2]).cast("long")
    place = F.when(small, top - SHIFT // LIMB).otherwise(top) - 2
    return place, [low, middle, high]


def partial_sums(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """keys, place, n (rows, NULLs as well), special and the limbs' sums: a row for each
    place that a group's doubles have, NULL for rows without a finite one."""
    x = F.col(amount).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    number = F.when(finite, x).otherwise(F.lit(0.0))
    place, limbs = _limbs(number)
    special = F.when(F.isnan(x), NAN).when(x == float("inf"), PLUS).when(x == float("-inf"), MINUS)
    rows = df.select(
        *keys,
        F.when(finite, place).alias(PLACE),
        special.alias(SPECIAL),
        *(limb.alias(name) for name, limb in zip(LIMBS, limbs)),
        # A task adds fewer rows than would make its whole numbers run over.
        F.spark_partition_id().alias("task"),
    )
    by = [*keys, PLACE, SPECIAL]
    sums = [F.sum(name).alias(name) for name in LIMBS]
    tasks = rows.groupBy(*by, "task").agg(F.count(F.lit(1)).alias(COUNT), *sums)
    return merged(tasks, by)


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    sums = [F.sum(F.col(name).cast(WHOLE)).cast(WHOLE).alias(name) for name in LIMBS]
    return parts.groupBy(*by).agg(F.sum(COUNT).alias(COUNT), *sums)


def _nearest(parts: list[dict]) -> float | None:
    """The double nearest to a group's sum; NULL where it has no number at all."""
    special = {p[SPECIAL] for p in parts} - {None}
    if NAN in special or {PLUS, MINUS} <= special:
        return float("nan")
    if special:
        return float(special.pop())
    places = [p for p in parts if p[PLACE] is not None]
    if not places:
        return None
    least = min(p[PLACE] for p in places)
    total = sum(
        int(p[name]) << (LIMB * (p[PLACE] - least + k)) for p in places for k, name in enumerate(LIMBS)
    )
    bits = LIMB * least
    try:
        # A quotient of whole numbers is rounded once.
        return float(total << bits) if bits >= 0 else total / (1 << -bits)
    except OverflowError:
        return float("inf") if total > 0 else float("-inf")


@F.arrow_udf(DoubleType())
def _rounded(groups: pa.Array) -> pa.Array:
    return pa.array([_nearest(parts) for parts in groups.to_pylist()], pa.float64())


def exact_sums(parts: DataFrame, keys: list[str], count: str, total: str) -> DataFrame:
    """keys, row count and sum of ``partial_sums``, of one or of several together."""
    rows = merged(parts, [*keys, PLACE, SPECIAL])
    # Some seventy places at most.
    listed = F.collect_list(F.struct(PLACE, SPECIAL, *LIMBS)).alias("parts")
    groups = rows.groupBy(*keys).agg(F.sum(COUNT).alias(count), listed)
    return groups.select(*keys, count, _rounded("parts").alias(total))
