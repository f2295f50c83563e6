"""The record bronze keeps of its landings: what came, from where, in which schema and run.

Landed objects are parts of snapshots below ``_landed``: an entry of their commit log
names the run that holds an object, and only that makes the object there. Each run has
its audit beside it.
"""

from __future__ import annotations

import json
from fnmatch import fnmatchcase
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from triplake.sources.objects import BronzeObject, glob_objects
from triplake.sources.snapshots import RUN, CommitLog

NAME, SOURCE = "object_name", "source_path"
COMMITTED = "_SUCCESS"

# In bronze, a folder that no object is named as.
MANIFEST = "_landed"
# Partition column that holds an object's name; no column of an object is named so.
OBJECT = "_object"
AUDIT = (
    f"{NAME} string, {SOURCE} string, n_rows long, fingerprint decimal(38,0), verified boolean, "
    "schema string, n_bytes long, digest string"
)
LANDED_AT = "landed_at"


def landing_log(spark: SparkSession, bronze: str) -> CommitLog:
    return CommitLog(spark, f"{bronze.rstrip('/')}/{MANIFEST}")


def name_of(part: str) -> str:
    return unquote(part.removeprefix(f"{OBJECT}="))


def part_of(spark: SparkSession, name: str) -> str:
    """The folder that Spark writes an object's rows to."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{OBJECT}={utils.escapePathName(name)}"


def committed_runs(spark: SparkSession, bronze: str) -> dict[str, tuple[str, str]]:
    """Run and part of every landed object, by its name."""
    parts = landing_log(spark, bronze).latest().parts
    return {name_of(part): (runs[-1], part) for part, runs in parts.items()}


def landed_in(spark: SparkSession, bronze: str) -> list[BronzeObject]:
    """What was landed in ``bronze``, in name order."""
    data = landing_log(spark, bronze).data
    found = []
    for name, (run, part) in sorted(committed_runs(spark, bronze).items()):
        path = f"{data}/{run}/{part}"
        found.append(BronzeObject(name, path, path, data, True, 0, landed=True))
    return found


def bronze_objects(spark: SparkSession, pattern: str) -> list[BronzeObject]:
    """Objects that fit ``pattern``: landed ones, and others that lie there by name."""
    folder, _, names = pattern.rpartition("/")
    landed: list[BronzeObject] = []
    hidden = set()
    for place in glob_objects(spark, f"{folder}/{MANIFEST}"):
        there = [o for o in landed_in(spark, place.path.rpartition("/")[0]) if fnmatchcase(o.name, names)]
        landed += there
        hidden |= {(place.folder, o.name) for o in there}
    plain = [o for o in glob_objects(spark, pattern) if o.name != MANIFEST and (o.folder, o.name) not in hidden]
    return sorted(landed + plain)


def stored_path(spark: SparkSession, path: str) -> str:
    """Where the object at ``path`` lies."""
    folder, _, name = path.rpartition("/")
    if not glob_objects(spark, f"{folder}/{MANIFEST}"):
        return path
    held = committed_runs(spark, folder).get(name)
    return f"{landing_log(spark, folder).data}/{held[0]}/{held[1]}" if held else path


def _audits(spark: SparkSession, bronze: str) -> str:
    return f"{landing_log(spark, bronze).root}/audit"


def keep_audit(audit: DataFrame, bronze: str, run: str) -> None:
    """The audit of a run, before the run is committed."""
    stamped = audit.withColumn(LANDED_AT, F.current_timestamp())
    stamped.coalesce(1).write.parquet(f"{_audits(audit.sparkSession, bronze)}/{run}")


def kept_audit(spark: SparkSession, bronze: str) -> DataFrame:
    """The audit row of every object that is landed in ``bronze``."""
    held = [(name, run) for name, (run, _) in committed_runs(spark, bronze).items()]
    if not held:
        return spark.createDataFrame([], AUDIT)
    at = _audits(spark, bronze)
    reader = spark.read.schema(f"{AUDIT}, {LANDED_AT} timestamp, {RUN} string").option("basePath", at)
    rows = reader.parquet(*(f"{at}/{run}" for run in sorted({run for _, run in held})))
    # Bounded by the names of objects, one a month.
    current = spark.createDataFrame([(n, r.removeprefix(f"{RUN}=")) for n, r in held], f"{NAME} string, {RUN} string")
    return rows.join(F.broadcast(current), [NAME, RUN]).drop(RUN, LANDED_AT)


def known_schemas(spark: SparkSession, objects: list[BronzeObject]) -> dict[str, StructType]:
    """Schemas of landed objects by path, from their audit."""
    known = {}
    for data in sorted({o.folder for o in objects if o.landed}):
        bronze = data.rpartition(f"/{MANIFEST}/")[0]
        texts = dict(kept_audit(spark, bronze).filter("schema is not null").select(NAME, "schema").collect())
        parsed = {text: StructType.fromJson(json.loads(text)) for text in set(texts.values())}
        known |= {o.path: parsed[texts[o.name]] for o in objects if o.folder == data and o.name in texts}
    return known
