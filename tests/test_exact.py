import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from triplake.functions.exact import exact_sums, merged, partial_sums

SCHEMA = "k string, x double"


def summed(df):
    rows = exact_sums(partial_sums(df, ["k"], "x"), ["k"], "n", "total").collect()
    return {r.k: (r.n, r.total) for r in rows}


def bits(x):
    return struct.pack("<d", x)


def any_double(rng):
    x = struct.unpack("<d", rng.randbytes(8))[0]
    return x if math.isfinite(x) and abs(x) < 1e300 else rng.uniform(-1e5, 1e5)


def cases():
    rng = random.Random(3)
    yield "money", [round(rng.uniform(900, 105000), 2) for _ in range(500)]
    yield "any", [any_double(rng) for _ in range(400)]
    yield "cancel", [1e300, 1.0, -1e300, 2.0**-1074, 1e16, -1e16, -1.0]
    yield "tiny", [rng.choice([-1, 1]) * 2.0 ** rng.randrange(-1074, -390) * rng.random() for _ in range(200)]
    yield "powers", [s * 2.0**e for e in range(-1074, 1000, 7) for s in (1, 1, -1)]
    yield "edges", [s * math.nextafter(2.0 ** (32 * e), d) for e in range(-30, 31) for s in (1, 1, -1) for d in (0, math.inf)]
    yield "zeros", [0.0, -0.0, 0.0]
    yield "half", [2.0**53, 1.0, 2.0**53, 1.0, 1.0]


def test_the_sum_is_rounded_once_whatever_the_order(spark):
    rows = [(k, x) for k, xs in cases() for x in xs]
    expected = {k: (len(xs), float(sum(map(Fraction, xs)))) for k, xs in cases()}
    for order, n in ((rows, 1), (rows[::-1], 3), (random.Random(1).sample(rows, len(rows)), 7)):
        found = summed(spark.createDataFrame(order, SCHEMA).repartition(n))
        assert {k: (n, bits(x + 0.0)) for k, (n, x) in found.items()} == {
            k: (n, bits(x)) for k, (n, x) in expected.items()
        }


def test_parts_can_be_merged_later(spark):
    rows = [(k, x) for k, xs in cases() for x in xs]
    parts = [partial_sums(spark.createDataFrame(rows[i::3], SCHEMA), ["k"], "x") for i in range(3)]
    both = merged(parts[0].union(parts[1]), ["k", "place", "special"])
    found = exact_sums(both.unionByName(parts[2]), ["k"], "n", "total").collect()
    assert {r.k: (r.n, r.total) for r in found} == summed(spark.createDataFrame(rows, SCHEMA))


def test_values_that_are_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    groups = {"nan": [1.0, nan], "up": [inf, 1.0], "down": [-inf, None], "both": [inf, -inf], "none": [None, None], "some": [None, 2.5]}
    over = {"high": [1.7e308] * 3, "low": [-1.7e308] * 3}
    rows = [(k, x) for k, xs in (groups | over).items() for x in xs]
    found = summed(spark.createDataFrame(rows, SCHEMA))
    assert math.isnan(found["nan"][1]) and math.isnan(found["both"][1])
    assert {k: v for k, v in found.items() if k not in ("nan", "both")} == {
        "up": (2, inf), "down": (2, -inf), "none": (2, None), "some": (2, 2.5), "high": (3, inf), "low": (3, -inf),
    }
    assert summed(spark.createDataFrame([], SCHEMA)) == {}


def test_rows_are_added_without_python(spark):
    plan = partial_sums(spark.range(10).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("x")), ["k"], "x")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Window" not in text


@pytest.mark.parametrize("n", [1, 100_000])
def test_many_copies_of_one_amount(spark, n):
    df = spark.range(n).select(F.lit("a").alias("k"), F.lit(0.1).alias("x"))
    assert summed(df) == {"a": (n, float(Fraction(0.1) * n))}
