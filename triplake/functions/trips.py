"""Column expressions over trips. All run inside Catalyst; no Python per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.schemas import NARROWED

# Bronze object names are <prefix>YYYY-MM<suffix>.
OBJECT_PREFIX = "yellow_tripdata_"
OBJECT_SUFFIX = ".parquet"

# The key's parts and the text between them.
TRIP_KEY_PARTS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "total_amount",
)
TRIP_KEY_SEPARATOR = "|"


def month_span(name: str) -> tuple[int, int]:
    """Where the month stands in a bronze object's name: start and length.

    Prefix and suffix are left out only where present.
    """
    start = len(OBJECT_PREFIX) if name.startswith(OBJECT_PREFIX) else 0
    end = len(name)
    if name[start:].endswith(OBJECT_SUFFIX):
        end -= len(OBJECT_SUFFIX)
    return start, end - start


def source_month(name: Column) -> Column:
    """Month in a column of bronze object names, by the same rule."""
    around = rf"^{re.escape(OBJECT_PREFIX)}|{re.escape(OBJECT_SUFFIX)}\z"
    return F.regexp_replace(name, around, "")


def _place_in_path(file_path: Column, folder: str) -> Column:
    """Where the step below ``folder`` (a URI) begins in a file's URI.

    Cutting at a known place is several times cheaper than a search, on every row
    there is.
    """
    below = "/" + folder.split(":", 1)[-1].strip("/") + "/"
    return F.instr(file_path, F.lit(below)) + len(below)


def name_in_path(file_path: Column, folder: str) -> Column:
    """Name of the object that holds a file: the first step below ``folder``, not the
    last, as an object is a file or a folder of part files."""
    rest = F.substring(file_path, _place_in_path(file_path, folder), F.length(file_path))
    return F.substring_index(rest, "/", 1)


def source_month_of_path(file_path: Column, folder: str, span: tuple[int, int]) -> Column:
    """Month of the bronze object that holds a file, from the file's URI."""
    start, length = span
    return F.substring(file_path, _place_in_path(file_path, folder) + start, F.lit(length))


def trip_id() -> Column:
    """Hash key. NULL parts are skipped, and equal trips share a key."""
    parts = [F.col(c).cast("string") for c in TRIP_KEY_PARTS]
    return F.sha2(F.concat_ws(TRIP_KEY_SEPARATOR, *parts), 256)


def partition_month() -> Column:
    return F.date_format("tpep_pickup_datetime", "yyyy-MM")


def month_key(pickup_column: str = "tpep_pickup_datetime") -> Column:
    """Month as one number, 202301 for January 2023."""
    pickup = F.col(pickup_column)
    return (F.year(pickup) * 100 + F.month(pickup)).cast("bigint")


def narrowed(name: str) -> Column:
    """Whole-number form; what does not fit an int becomes NULL, also under ANSI."""
    return F.col(name).try_cast("int").alias(name)


def prepare_trips(aligned: DataFrame, keyed: bool = True) -> DataFrame:
    """Aligned trips with narrowed columns, trip_id and partition_month.

    The key is taken from the columns as they were aligned, none of which is narrowed.
    Without ``keyed`` it is left out, for ``TRIP_DERIVED`` to add behind a shuffle.
    """
    columns = [narrowed(c) if c in NARROWED else F.col(c) for c in aligned.columns]
    key = [trip_id().alias("trip_id")] if keyed else []
    return aligned.select(*columns, *key, partition_month().alias("partition_month"))


# Columns that no rule looks at, each with the function that makes it of the others.
TRIP_DERIVED = {"trip_id": trip_id}
