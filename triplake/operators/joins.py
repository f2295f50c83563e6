"""Left join with a lookup that is too large to broadcast, under frequent keys.

How often keys come is counted first, by partial aggregation over the key alone. Keys
with more than a 4096th of all rows, NULL included, are few: rows that have one of them
stay where they are and meet the lookup's rows of these keys, which are broadcast where
they are counted to be small, or else dealt over copies. All other rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FREQUENT = 4096
COPIES = 64


def frequent_keys(rows: DataFrame, key: Column) -> DataFrame:
    """Keys (``_key``) that come in more than a 4096th of the rows: 4096 at most."""
    counts = rows.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count()
    return counts.filter(F.col("_n") > total / FREQUENT).select("_key")


def spread_left_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    small,
    frequent: DataFrame | None = None,
) -> DataFrame:
    """All ``rows`` with the columns of the lookup rows that have their key. ``small`` marks
    a side for broadcast if it is counted to be small, or gives it back as it is."""
    known = F.broadcast(frequent if frequent is not None else frequent_keys(rows, F.col(key)))
    hot_row = F.col(key).eqNullSafe(F.col("_key"))
    hot, rest = rows.join(known, hot_row, "left_semi"), rows.join(known, hot_row, "left_anti")
    hot_lookup = lookup.join(known, F.col(lookup_key) == F.col("_key"), "left_semi")
    same = F.col(key) == F.col(lookup_key)
    marked = small(hot_lookup)
    if marked is not hot_lookup:
        joined = hot.join(marked, same, "left")
    else:
        # Every copy of a key's lookup rows meets a share of the key's rows.
        numbers = F.array(*(F.lit(i) for i in range(COPIES)))
        copies = hot_lookup.withColumn("_copy", F.explode(numbers))
        dealt = hot.withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.lit(COPIES)).cast("int"))
        joined = dealt.join(copies, same & (F.col("_share") == F.col("_copy")), "left").drop("_share", "_copy")
    return joined.unionByName(rest.join(lookup, same, "left"))
