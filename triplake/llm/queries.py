"""The numbered queries: each operator over the whole table it is meant for."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import (
    bpe_codec,
    circulant_minhash,
    conversation_repair,
    merkle_manifest,
    mixing,
    ngram_join,
    quality_classifier,
    quality_rules,
    repair_files,
    secret_scan,
    spotsigs,
    toxicity,
    url_templates,
)
from triplake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def reach_workers(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, also if the session
    was made in another folder. Clusters that have it installed are not touched."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def _with_workers(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return query(spark, sf_dir)

    return run


def op1_url_templates(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    bad = labels.select(
        F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return url_templates.judged_pages(table(spark, sf_dir, "pages"), bad)


def op2_quality_rules(spark, sf_dir):
    return quality_rules.judged_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_join(spark, sf_dir):
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op5_bpe_automaton(spark, sf_dir):
    return bpe_codec.round_trips(table(spark, sf_dir, "documents"))


def op6_spotsigs(spark, sf_dir):
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.quality_scores(documents, labels)


def op8_mixing(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.document_rates(documents, labels, bounded=False)


def op9_secret_scan(spark, sf_dir):
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op10_repair_files(spark, sf_dir):
    return repair_files.document_positions(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repaired_conversations(table(spark, sf_dir, "conversations"))


def op12_circulant_minhash(spark, sf_dir):
    return circulant_minhash.deduplicated(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle_manifest.verified(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: _with_workers(f)
    for f in (
        op1_url_templates,
        op2_quality_rules,
        op3_toxicity,
        op4_ngram_join,
        op5_bpe_automaton,
        op6_spotsigs,
        op7_quality_classifier,
        op8_mixing,
        op9_secret_scan,
        op10_repair_files,
        op11_conversation_repair,
        op12_circulant_minhash,
        op13_merkle_manifest,
    )
}
