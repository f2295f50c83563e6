"""Footers, listings and byte ranges of stored files, read by tasks.

Listing comes from Spark's own reader, which leaves contents alone. Footers and byte
ranges are read in Python tasks, for which a file has to be in a store that pyarrow
knows; ``reachable`` tells, and callers have another way beyond it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.sources.objects import BronzeObject

# What Spark calls a store, and what pyarrow does.
SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs"}
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

# A digest's blocks and how many nodes make the next level's one. Fixed once digests are
# kept; the size of ranges is not part of a digest.
DIGEST_BLOCK, DIGEST_FAN = 1 << 20, 1024
RANGE_BYTES = 64 << 20


def _split(path: str) -> tuple[str, str, str]:
    """Scheme, authority and path."""
    scheme, _, rest = ("file", "", path) if path.startswith("/") else path.partition(":")
    if not rest.startswith("//"):
        return scheme, "", rest
    authority, _, below = rest[2:].partition("/")
    return scheme, authority, "/" + below


def reachable(path: str) -> bool:
    """Whether Python tasks can open files of this path's store."""
    return _split(path)[0] in SCHEMES


def opened(path: str) -> pa.NativeFile:
    """A file at a path as Hadoop writes it (not encoded)."""
    scheme, authority, below = _split(path)
    kind = SCHEMES[scheme]
    if kind == "file":
        return pafs.LocalFileSystem().open_input_file(below)
    store, _ = pafs.FileSystem.from_uri(f"{kind}://{authority}/")
    return store.open_input_file(below if kind == "hdfs" else authority + below)


def files_of(spark: SparkSession, objects: list[BronzeObject]) -> DataFrame:
    """object (position in ``objects``), path and length of every file of the objects,
    which are files, or folders of part files. Spark leaves empty files out."""
    listed = spark.read.format("binaryFile").load([o.path for o in objects])
    folder = F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)")
    rows = listed.select("path", "length", F.explode(F.array(F.col("path"), folder)).alias("at"))
    numbered = spark.createDataFrame([(i, o.path) for i, o in enumerate(objects)], "object int, at string")
    # One row for each object, which the driver holds as well.
    return rows.join(F.broadcast(numbered), "at").select("object", "path", "length")


FOOTER = "object int, path string, n_bytes long, n_rows long, columns array<string>"


def _columns(meta: pq.FileMetaData) -> list[str]:
    """``name type`` of each column: as Spark wrote it down, or else as Parquet has it."""
    written = (meta.metadata or {}).get(SPARK_SCHEMA)
    if written:
        fields = json.loads(written)["fields"]
        types = ((f["name"], f["type"]) for f in fields)
        return sorted(f"{n} {t if isinstance(t, str) else json.dumps(t, sort_keys=True)}" for n, t in types)
    columns = (meta.schema.column(i) for i in range(len(meta.schema)))
    return sorted(f"{c.path} {c.physical_type}/{c.logical_type}" for c in columns)


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for number, path, length in zip(*(c.to_pylist() for c in batch.columns)):
            with opened(path) as source:
                meta = pq.read_metadata(source)
            rows.append((number, path, length, meta.num_rows, _columns(meta)))
        if rows:
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            names = ("object", "path", "n_bytes", "n_rows", "columns")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def footers(spark: SparkSession, objects: list[BronzeObject]) -> DataFrame:
    """A row for each Parquet file of the objects, from its footer."""
    return files_of(spark, objects).mapInArrow(_read_footers, FOOTER)


def object_footers(spark: SparkSession, objects: list[BronzeObject]) -> DataFrame:
    """A row for each object: its files, bytes and rows, and the columns that any of its
    files has, in order."""
    rows = footers(spark, objects).groupBy("object")
    return rows.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_bytes").alias("n_bytes"),
        F.sum("n_rows").alias("n_rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("columns")))).alias("columns"),
    )


# --- digests of delivered bytes ----------------------------------------------

LEAF = "object int, path string, n_bytes long, idx long, digest string"


def _read_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Digests of the blocks of each range; a task holds one block at a time."""
    for batch in batches:
        for number, path, length, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
            digests = []
            with opened(path) as source:
                source.seek(begin)
                for at in range(begin, max(end, begin + 1), block):
                    digests.append(hashlib.sha256(source.read(min(block, end - at))).hexdigest())
            first, n = begin // block, len(digests)
            values = [[number] * n, [path] * n, [length] * n, range(first, first + n), digests]
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
            names = ("object", "path", "n_bytes", "idx", "digest")
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)


def file_digests(
    spark: SparkSession,
    objects: list[BronzeObject],
    range_bytes: int = RANGE_BYTES,
    block: int = DIGEST_BLOCK,
    fan: int = DIGEST_FAN,
) -> DataFrame:
    """object, path, n_bytes and digest of every file, by its bytes.

    Files are cut into ranges, which are rows that any task takes, so a file may be
    larger than what a task can hold. A file's blocks are leaves of a tree; ``fan`` digests
    in a row, as text, make one of the next level, until one remains. Ranges of other
    sizes give the same.
    """
    if range_bytes % block:
        raise ValueError("a range has to be of whole blocks")
    last = F.greatest(F.col("length") - 1, F.lit(0))
    begins = F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(range_bytes).cast("long")))
    ranges = files_of(spark, objects).select("object", "path", "length", begins.alias("begin"))
    ranges = ranges.withColumn("end", F.least(F.col("begin") + range_bytes, F.col("length")))
    spread = ranges.repartition("path", "begin")
    nodes = spread.mapInArrow(lambda batches: _read_blocks(batches, block), LEAF)
    longest = files_of(spark, objects).agg(F.max("length")).first()[0] or 0
    width, left = block, -(-longest // block)
    while left > 1:
        # What was one node already is the digest.
        whole = F.col("n_bytes") <= width
        group = F.floor(F.col("idx") / fan).cast("long").alias("idx")
        children = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        joined = F.array_join(F.transform(children, lambda c: c["digest"]), "")
        nodes = nodes.groupBy("object", "path", "n_bytes", group).agg(joined.alias("digest"))
        digest = F.when(whole, F.col("digest")).otherwise(F.sha2("digest", 256))
        nodes = nodes.withColumn("digest", digest)
        width, left = width * fan, -(-left // fan)
    return nodes.drop("idx")


def object_digests(spark: SparkSession, objects: list[BronzeObject]) -> DataFrame:
    """object, n_bytes and one digest for each object: of its files' names and digests."""
    name = F.substring_index("path", "/", -1)
    lines = F.array_sort(F.collect_list(F.concat(name, F.lit(" "), F.col("digest"))))
    rows = file_digests(spark, objects).groupBy("object")
    digest = F.sha2(F.array_join(lines, "\n"), 256)
    return rows.agg(F.sum("n_bytes").alias("n_bytes"), digest.alias("digest"))
