"""Rates without bounds against a plain numpy fit, and op8's query, which uses them."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from triplake.llm import mixing
from triplake.llm.queries import QUERIES

SF_DIR = os.environ.get("TRIPLAKE_SF_DIR", "/root/testdata/sf0.001")
GOAL = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])


def posteriors(shares, softness, n=200):
    pick = np.random.default_rng(7)
    truth = np.eye(3)[pick.choice(3, n, p=shares)]
    soft = np.exp(8 * truth + pick.normal(0, softness, (n, 3)))
    return pick.integers(1, 300, n), soft / soft.sum(axis=1, keepdims=True)


def frame(spark, tokens, p):
    rows = [(int(k), *map(float, x)) for k, x in zip(tokens, p)]
    return spark.createDataFrame(rows, "n_tokens long, p_clean double, p_junk double, p_toxic double").coalesce(1).cache()


def plain_fit(tokens, p, steps=200_000):
    """Rates of 0 or more nearest to 1 that meet the targets, by small steps of the multipliers."""
    goal = GOAL * tokens.sum()
    size = np.sqrt((tokens[:, None] * p * p).sum(axis=0))
    a = p / size
    multipliers, pace = np.zeros(3), 1 / np.linalg.eigvalsh(a.T @ (tokens[:, None] * a)).max()
    for _ in range(steps):
        rates = np.maximum(0, 1 - a @ multipliers)
        error = a.T @ (tokens * rates) - goal / size
        if (np.abs(error * size) <= 1e-7 * goal).all():
            return rates
        multipliers += pace * error
    raise AssertionError("the plain fit has not settled")


def rated(rows, rates):
    """Rates in the order of the rows, and the totals they lead to."""
    found = rows.withColumn("rate", rates.column()).collect()
    totals = np.array([sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in found) for d in mixing.DOMAINS])
    return np.array([r.rate for r in found]), totals


@pytest.mark.parametrize("softness", [0.5, 2.5])
@pytest.mark.parametrize("shares", [(0.62, 0.35, 0.03), (0.3, 0.6, 0.1), (0.05, 0.05, 0.9), (0.98, 0.01, 0.01)])
def test_rates_are_those_of_a_plain_fit(spark, shares, softness):
    tokens, p = posteriors(shares, softness)
    rows = frame(spark, tokens, p)
    rates = mixing.fit_free_rates(rows)
    found, totals = rated(rows, rates)
    assert rates.met and rates.passes < 20
    assert totals == pytest.approx(GOAL * tokens.sum(), rel=3e-3)
    assert totals == pytest.approx(rates.totals)
    assert found.min() >= 0
    assert found == pytest.approx(plain_fit(tokens, p), rel=0.02, abs=0.02)


def test_a_domain_without_tokens_is_reported_and_the_others_meet_their_targets(spark):
    tokens = np.array([10, 20, 30])
    rows = frame(spark, tokens, np.array([[1, 0, 0], [0, 1, 0], [1, 0, 0]]))
    with pytest.warns(UserWarning, match="toxic 0 of"):
        rates = mixing.fit_free_rates(rows)
    found, totals = rated(rows, rates)
    assert not rates.met and totals == pytest.approx([57, 2.4, 0], rel=2e-3)
    assert found == pytest.approx([1.425, 0.12, 1.425], rel=2e-3)


def test_rows_without_tokens(spark):
    rows = frame(spark, np.array([0, 0]), np.array([[1, 0, 0], [0, 1, 0]]))
    rates = mixing.fit_free_rates(rows)
    assert rated(rows, rates)[0].tolist() == [1, 1] and rates.totals == [0, 0, 0]
    assert mixing.fit_free_rates(rows.filter("false")).met


def test_free_rates_of_odd_documents(docs, labels):
    nothing = labels().filter("false")
    found = mixing.document_rates(docs("a b", None, "", "a b"), nothing, bounded=False).collect()
    assert len(found) == 4
    assert mixing.document_rates(docs(), nothing, bounded=False).count() == 0


def test_the_query_meets_its_targets(spark):
    found = QUERIES["op8_mixing"](spark, SF_DIR)
    n_documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    totals = [F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS]
    *reached, tokens, n, least, apart = found.agg(
        *totals, F.sum("n_tokens"), F.count(F.lit(1)), F.min("rate"), F.max(F.abs(F.col("copies") - F.col("rate")))
    ).first()
    assert reached == pytest.approx(list(GOAL * tokens), rel=3e-3)
    assert n == n_documents and least >= 0 and apart < 1
