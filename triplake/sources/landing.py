"""Land delivered objects in bronze: only those not there yet, or all by force.

Parquet objects of one schema are copied together: a job writes them to a run of its own,
without a shuffle, and an entry in bronze's commit log makes them objects. Nothing is
renamed, and nothing of a run is seen before its entry, so a landing that is lost half
way leaves no trace but files. Another job reads what was delivered and what was landed,
and compares their content object by object. The driver goes over object names (one per
month), never over rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triplake.functions.trips import OBJECT_PREFIX, OBJECT_SUFFIX
from triplake.session import sortable_scans
from triplake.sources.bronze import BronzeGroup, group_objects, group_of, merged_parts
from triplake.sources.footers import object_digests, reachable
from triplake.sources.manifest import (
    AUDIT,
    COMMITTED,
    MANIFEST,
    NAME,
    OBJECT,
    SOURCE,
    bronze_objects,
    committed_runs,
    keep_audit,
    landing_log,
    part_of,
    stored_path,
)
from triplake.sources.manifest import kept_audit as kept_audit
from triplake.sources.objects import BronzeObject, glob_objects

# Text objects are CSV with a header; blanks are kept.
TEXT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def monthly_objects(
    spark: SparkSession, source: str, months: list[str], others: list[str]
) -> DataFrame:
    """Objects a source delivers for ``months`` (``YYYY-MM``), and others by name."""
    names = [f"{OBJECT_PREFIX}{month}{OBJECT_SUFFIX}" for month in months] + others
    rows = [(name, f"{source.rstrip('/')}/{name}") for name in names]
    return spark.createDataFrame(rows, f"{NAME} string, {SOURCE} string")


def missing_objects(wanted: DataFrame, landed: DataFrame, force: bool = False) -> DataFrame:
    """Wanted objects that are not landed; all of them when forced."""
    return wanted if force else wanted.join(landed.select(NAME), NAME, "left_anti")


def landed_objects(spark: SparkSession, bronze: str) -> DataFrame:
    """Names that are fully landed: those the commit log names, and others that lie in
    ``bronze`` by name, of which a folder counts once its write was committed."""
    committed = {marker.folder for marker in glob_objects(spark, f"{bronze}/*/{COMMITTED}")}
    names = {
        o.name
        for o in glob_objects(spark, f"{bronze}/*")
        if o.name != MANIFEST and (not o.is_folder or o.uri in committed)
    }
    rows = [(name,) for name in sorted(names | committed_runs(spark, bronze).keys())]
    return spark.createDataFrame(rows, f"{NAME} string")


def fingerprint_columns(columns: list[str]) -> list[Column]:
    """Row count and a hash of the content that does not depend on the order of rows
    or columns."""
    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in sorted(columns))).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(row_hash).alias("fingerprint")]


def delivered(spark: SparkSession, name: str, path: str, encoding: str = "UTF-8") -> DataFrame:
    """An object's rows, with the columns of all its part files.

    Columns of a text object are strings, as Spark's CSV reader sees them: a short line
    has NULLs, and fields beyond the header are left out. Parts whose headers differ fail.
    """
    if name.endswith(OBJECT_SUFFIX):
        return merged_parts(spark, path)
    return spark.read.options(encoding=encoding, enforceSchema=False, **TEXT).csv(path)


def land(
    spark: SparkSession,
    wanted: DataFrame,
    bronze: str,
    force: bool = False,
    encoding: str = "UTF-8",
    digests: bool = False,
) -> DataFrame:
    """Copy what is missing and return one audit row per copied object.

    Copies are read back: ``verified`` tells whether they hold what was delivered. Text
    in another ``encoding`` is landed as UTF-8, object by object. With ``digests`` the
    audit has the size and a digest of the delivered bytes as well. The audit and the
    schemas are also kept in bronze.
    """
    todo = missing_objects(wanted, landed_objects(spark, bronze), force)
    sources = dict(todo.select(NAME, SOURCE).orderBy(NAME).collect())
    objects = [_delivered_object(spark, n, s) for n, s in sources.items()]
    found = _digests(spark, objects) if digests else {}
    audits = []
    for obj in objects:
        if not obj.name.endswith(OBJECT_SUFFIX):
            rows = delivered(spark, obj.name, sources[obj.name], encoding)
            run, seen = _land_text(spark, rows, obj.name, bronze)
            audits += _commit(spark, bronze, run, {obj.name: seen}, sources, found)
    tables = [o for o in objects if o.name.endswith(OBJECT_SUFFIX)]
    for group in group_objects(spark, tables):
        run, seen = write_group(spark, group, bronze)
        audits += _commit(spark, bronze, run, seen, sources, found)
    return spark.createDataFrame(audits, AUDIT)


def _digests(spark: SparkSession, objects: list[BronzeObject]) -> dict[str, tuple]:
    beyond = [o.path for o in objects if not reachable(o.path)]
    if beyond:
        raise ValueError(f"tasks cannot read the bytes of {beyond[0]}")
    rows = object_digests(spark, objects).collect() if objects else []
    # An object of empty files has no row.
    empty = {o.name: (0, hashlib.sha256().hexdigest()) for o in objects}
    return empty | {objects[r["object"]].name: (r.n_bytes, r.digest) for r in rows}


def _commit(
    spark: SparkSession, bronze: str, run: str, seen: dict[str, tuple], sources: dict[str, str], digests: dict[str, tuple]
) -> list[tuple]:
    """The audit of a run, kept; then the entry that makes its objects seen."""
    rows = [(n, sources[n], *content, *digests.get(n, (None, None))) for n, content in seen.items()]
    keep_audit(spark.createDataFrame(rows, AUDIT), bronze, run)
    parts = [part_of(spark, name) for name in seen]
    landing_log(spark, bronze).commit({run: parts}, replaced=set(parts).__contains__)
    return rows


def verify_landed(spark: SparkSession, audit: DataFrame, bronze: str) -> list[str]:
    """Audited objects whose content in bronze is not what was delivered."""
    rows = audit.orderBy(NAME).collect()
    tables = {row[NAME] for row in rows if row[NAME].endswith(OBJECT_SUFFIX)}
    objects = [o for o in bronze_objects(spark, f"{bronze}/*{OBJECT_SUFFIX}") if o.name in tables]
    found: dict[str, tuple] = {}
    for group in group_objects(spark, objects):
        found |= _contents(spark, group)
    for row in rows:
        if row[NAME] not in tables:
            path = stored_path(spark, f"{bronze}/{row[NAME]}")
            found[row[NAME]] = _content(delivered(spark, row[NAME], path))
    return [row[NAME] for row in rows if found.get(row[NAME]) != (row.n_rows, row.fingerprint)]


def _delivered_object(spark: SparkSession, name: str, source: str) -> BronzeObject:
    """The object at ``source``, by the name it is to be landed under."""
    found = glob_objects(spark, source)
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} objects at {source}")
    return found[0]._replace(name=name)


def _content(rows: DataFrame) -> tuple:
    if not rows.columns:
        return 0, None
    return tuple(rows.agg(*fingerprint_columns(rows.columns)).first())


def _contents(spark: SparkSession, group: BronzeGroup) -> dict[str, tuple]:
    """Content of every object of a group, in one job. An object without rows counts 0."""
    sums = fingerprint_columns(group.schema.names)
    found = group.rows(spark).groupBy(group.object_name).agg(*sums).collect()
    return {o.name: (0, None) for o in group.objects} | {r[0]: (r[1], r[2]) for r in found}


def write_group(spark: SparkSession, group: BronzeGroup, bronze: str) -> tuple[str, dict[str, tuple]]:
    """Copy objects of one schema to a run; by object its row count, fingerprint, verdict
    and schema. The run is not committed."""
    log = landing_log(spark, bronze)
    run = log.new_run()
    named = group.rows(spark).select(*(f"`{n}`" for n in group.schema.names), group.object_name.alias(OBJECT))
    with sortable_scans(spark):
        named.write.partitionBy(OBJECT).parquet(log.path(run))
    written = set(log.parts_of(run, 1))
    copies = group_of(group.schema, group.objects[0]._replace(landed=True))
    for obj in group.objects:
        part = part_of(spark, obj.name)
        path = f"{log.path(run)}/{part}"
        if part not in written:
            # No rows, so no folder.
            spark.createDataFrame([], group.schema).write.parquet(path)
        copies.objects.append(BronzeObject(obj.name, path, path, log.data, True, 0, landed=True))
    came, there, schema = _contents(spark, group), _contents(spark, copies), group.schema.json()
    return run, {name: (*content, there.get(name) == content, schema) for name, content in came.items()}


def _land_text(spark: SparkSession, rows: DataFrame, name: str, bronze: str) -> tuple[str, tuple]:
    """Store a text object in a run; row count, fingerprint, verdict, and no schema."""
    log = landing_log(spark, bronze)
    run = log.new_run()
    target = f"{log.path(run)}/{part_of(spark, name)}"
    if not rows.columns:
        # A text object without a line.
        spark.createDataFrame([], "value string").write.text(target)
        return run, (0, None, True, None)
    seen = Observation("landed")
    rows = rows.observe(seen, *fingerprint_columns(rows.columns))
    rows.write.options(**TEXT).csv(target)
    content = seen.get["n_rows"], seen.get["fingerprint"]
    return run, (*content, _content(delivered(spark, name, target)) == content, None)
