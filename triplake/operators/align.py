"""Impose a declared schema on frames whose physical schema drifts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType, TimestampNTZType, TimestampType


def _is_instant(present: DataType | None, field: StructField) -> bool:
    return isinstance(present, TimestampType) and isinstance(field.dataType, TimestampNTZType)


def utc_wall_time(instant: Column) -> Column:
    """What a clock in UTC shows, whatever zone the session is in."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), origin)


def align_columns(
    present: Iterable[str], schema: StructType, types: Mapping[str, DataType] = MappingProxyType({})
) -> list[Column]:
    """One expression per declared column, in declared order.

    Names match without regard to case, so a renamed-by-case column keeps its
    values. An absent column is a typed NULL; a value that does not fit is NULL.
    """
    found: dict[str, list[str]] = {}
    for name in present:
        found.setdefault(name.lower(), []).append(name)

    columns = []
    for field in schema:
        names = found.get(field.name.lower(), [])
        if len(names) > 1:
            raise ValueError(f"{field.name}: more than one column fits: {names}")
        if names:
            quoted = names[0].replace("`", "``")
            value = F.col(f"`{quoted}`")
            if _is_instant(types.get(names[0]), field):
                value = utc_wall_time(value)
            value = value.try_cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return columns


def align(df: DataFrame, schema: StructType, *tags: Column) -> DataFrame:
    """``df`` in the declared schema, followed by ``tags``, in a single select."""
    return df.select(*align_columns(df.columns, schema, {f.name: f.dataType for f in df.schema}), *tags)


def union_aligned(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
