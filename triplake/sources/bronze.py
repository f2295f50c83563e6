"""Read the bronze layer: monthly trip objects and the zone lookup."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from triplake.functions.trips import month_span, name_in_path, source_month_of_path
from triplake.operators.align import align, union_aligned
from triplake.schemas import BRONZE_TRIPS, ZONES
from triplake.sources.footers import object_footers, reachable
from triplake.sources.manifest import OBJECT, bronze_objects, known_schemas, stored_path
from triplake.sources.objects import BronzeObject
from triplake.sources.objects import glob_objects as glob_objects
from triplake.sources.snapshots import RUN

# Schema look-ups that run side by side on the driver.
SCHEMA_THREADS = 16
# Column of a text file's line as it is, where it is a bad one.
BAD_LINE = "_bad_line"


class BronzeGroup(NamedTuple):
    """Objects that one read takes together."""

    schema: StructType
    objects: list[BronzeObject]
    object_name: Column
    source_month: Column

    @property
    def paths(self) -> list[str]:
        return [o.path for o in self.objects]

    def rows(self, spark: SparkSession) -> DataFrame:
        if not self.objects[0].landed:
            return spark.read.schema(self.schema).parquet(*self.paths)
        # The folders of run and object become columns.
        schema = StructType([*self.schema, *(StructField(c, StringType()) for c in (RUN, OBJECT))])
        reader = spark.read.schema(schema).option("basePath", self.objects[0].folder)
        return reader.parquet(*self.paths)


def merged_parts(spark: SparkSession, path: str) -> DataFrame:
    """An object with the columns of all its part files. Parts that give one column
    types that do not go together fail here, rather than lose it."""
    return spark.read.option("mergeSchema", True).parquet(path)


def object_schemas(spark: SparkSession, objects: list[BronzeObject]) -> list[StructType]:
    """The schema of each object: as landed, or else from the footers of its parts.

    One job reads all footers, and Spark derives the schema of one object for each
    distinct set of columns. Where tasks cannot open the files, it does so for each object.
    """
    known = known_schemas(spark, objects)
    new = [o for o in objects if o.path not in known]
    alike = {o.path: o.path for o in new}
    if new and all(reachable(o.path) for o in new):
        for row in object_footers(spark, new).select("object", "columns").collect():
            alike[new[row["object"]].path] = tuple(row["columns"])
    first = {key: path for path, key in reversed(alike.items())}
    with ThreadPoolExecutor(SCHEMA_THREADS) as pool:
        derived = dict(zip(first, pool.map(lambda p: merged_parts(spark, p).schema, first.values())))
    return [known.get(o.path) or derived[alike[o.path]] for o in objects]


def schema_groups(spark: SparkSession, objects: list[BronzeObject]) -> DataFrame:
    """A row for each distinct set of columns: the names of its objects, their files and
    rows, from footers alone."""
    names = spark.createDataFrame([(i, o.name) for i, o in enumerate(objects)], "object int, name string")
    rows = object_footers(spark, objects).join(F.broadcast(names), "object")
    return rows.groupBy("columns").agg(
        F.array_sort(F.collect_list("name")).alias("objects"),
        F.sum("n_files").alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
    )


def group_objects(spark: SparkSession, objects: list[BronzeObject]) -> list[BronzeGroup]:
    """Objects of the same folder, columns and types, and the same form of name.

    A single read over files whose types differ fails, and one read per object
    makes the plan grow with time. There are few distinct schemas. Column order
    does not matter, as Parquet columns are read by name.
    """
    groups: dict[tuple, BronzeGroup] = {}
    for obj, schema in zip(objects, object_schemas(spark, objects)):
        columns = tuple(sorted((f.name, f.dataType.simpleString()) for f in schema))
        form = month_span(obj.name) if _plain(obj) else obj.name
        groups.setdefault((obj.folder, columns, form), group_of(schema, obj)).objects.append(obj)
    return list(groups.values())


def _plain(obj: BronzeObject) -> bool:
    """Whether the object's name is in the paths of its files as it is, or in a column."""
    return obj.landed or obj.uri.endswith("/" + obj.name)


def group_of(schema: StructType, like: BronzeObject) -> BronzeGroup:
    """A group without objects yet, for objects in the folder and form of ``like``."""
    if like.landed:
        start, length = month_span(like.name)
        name, month = F.col(OBJECT), F.substring(OBJECT, start + 1, length)
    elif _plain(like):
        path = F.col("_metadata.file_path")
        name = name_in_path(path, like.folder)
        month = source_month_of_path(path, like.folder, month_span(like.name))
    else:
        name, month = F.lit(like.name), F.lit(month_of(like.name))
    return BronzeGroup(schema, [], name.alias("object_name"), month.alias("source_month"))


def read_bronze_trips(
    spark: SparkSession, pattern: str, months: tuple[str, ...] | None = None
) -> DataFrame:
    """All bronze trips in the declared schema, tagged with their object's month.

    With ``months`` only the objects of those months are read.
    """
    objects = bronze_objects(spark, pattern)
    if months is not None:
        objects = [o for o in objects if month_of(o.name) in months]
    if not objects:
        raise FileNotFoundError(f"no bronze objects at {pattern}")
    return union_aligned(
        align(g.rows(spark), BRONZE_TRIPS, g.source_month) for g in group_objects(spark, objects)
    )


def month_of(name: str) -> str:
    start, length = month_span(name)
    return name[start : start + length]


def _zone_lines(spark: SparkSession, path: str, schema: StructType, check_header: bool) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    # All columns are looked at, whichever are asked for, as any of them can be a bad one.
    some = not check_header and BAD_LINE not in schema.names
    reader = reader.option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", some)
    reader = reader.option("enforceSchema", not check_header)
    return reader.csv(stored_path(spark, path))


def read_zones_csv(spark: SparkSession, path: str, check_header: bool = False) -> DataFrame:
    """Zone lookup. Columns go by position and the header line is skipped; a value that
    does not fit its type, or is missing, is NULL. With ``check_header`` a file whose
    header has other names, or has them in another order, fails."""
    return _zone_lines(spark, path, ZONES, check_header)


# What is wrong with a line.
FIELDS, TYPE = "number of fields", "type of a value"


def zones_csv_rejects(spark: SparkSession, path: str, check_header: bool = True) -> DataFrame:
    """line and reason of every line that has not as many fields as the lookup, or a value
    that does not fit its type. Such lines are in ``read_zones_csv`` as well, with NULLs."""
    marked = StructType([*ZONES, StructField(BAD_LINE, StringType())])
    number = F.col(ZONES.names[0])
    # Spark refuses to read bad lines by themselves, so the filter looks at a value as well.
    looked = F.greatest(F.length(BAD_LINE), F.coalesce(number % 1, F.lit(0))) >= 0
    bad = _zone_lines(spark, path, marked, check_header).filter(F.col(BAD_LINE).isNotNull() & looked)
    # As texts, a line is only bad if it has more fields, or fewer.
    texts = ", ".join(f"{name} STRING" for name in [*ZONES.names, BAD_LINE])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    counted = F.from_csv(F.col(BAD_LINE), texts, options)[BAD_LINE]
    # The id is the one column that is not a text.
    reason = F.when(counted.isNotNull(), FIELDS).when(number.isNull(), TYPE)
    return bad.select(F.col(BAD_LINE).alias("line"), reason.alias("reason"))
