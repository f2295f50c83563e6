"""The corpus pipeline: stages that hand documents on through Parquet.

Every stage takes all that the stage before it kept. All but the last give back the
columns of ``documents``; the last encodes what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from triplake.llm import bpe_codec, mixing, ngram_join, secret_scan, toxicity
from triplake.llm.common import stored, table
from triplake.llm.queries import reach_workers

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    reach_workers(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their n-grams, one of each group stays."""
    reach_workers(spark)
    return ngram_join.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; all documents stay."""
    reach_workers(spark)
    return secret_scan.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Junk and leftover toxic documents are thinned to the target weights."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of what they decode to."""
    reach_workers(spark)
    return bpe_codec.round_trips(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("bpe_encoding", encode),
]

# Training, MinHash bands and BPE have no form in SQL; the tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
