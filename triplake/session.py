"""The few things taken from the running session; no session is made here."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# Stored bytes that a task sorts. Monthly files hold a trip in some 12 bytes or more and a
# row to sort has some 300, so that this is below half a GB.
SORTED_BYTES = 16 << 20
_UNITS = {"": 0, "b": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the session.

    Only a local session that names none falls back to a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get(CHECKPOINT_DIR, None) or conf.get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="triplake-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/triplake-{label}-{uuid.uuid4().hex}"


def byte_size(text: str) -> int:
    """Bytes of a size as settings are written: ``16m``, ``128MB``, ``4096``."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]?)b?\s*", text.lower()).groups()
    return int(number) << 10 * _UNITS[unit]


@contextmanager
def sortable_scans(spark: SparkSession) -> Iterator[None]:
    """Within, scans are split so finely that a task can sort its rows in memory.

    Writes by month sort each task's rows. Stored rows take a small part of what they take
    in memory, so tasks of the usual 128 MiB spill most of what they sort. A session that
    splits finer keeps to that.
    """
    usual = spark.conf.get(SPLIT_BYTES)
    if byte_size(usual) <= SORTED_BYTES:
        yield
        return
    spark.conf.set(SPLIT_BYTES, str(SORTED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_BYTES, usual)
