"""Join helpers: broadcast only behind a size check, anti joins that ignore NULL keys.

A dimension is broadcast only after its rows have been measured in bytes: one
aggregate over its own columns, a partial sum per task. Beyond the bound the
join is left to Spark: sort-merge with AQE, which may still switch to broadcast
at runtime from the real shuffle statistics. Only the join strategy depends on
the size, never the result. Literal relations (``VALUES``) have a size fixed in
code and need no measurement: their callers broadcast them directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a dimension that may be shipped to every executor.
BROADCAST_BYTES = 16 << 20


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: text as long as it is, anything else 8 bytes."""
    size = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return size.cast("long")


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes``."""
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_bytes


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if it is measured small, else ``df`` unchanged."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                broadcast_parent: bool | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent (relationship check, C7).

    A plain left-anti join keeps NULL child keys; the reference semantics let
    them pass, so they are filtered first. The child is pre-aggregated to
    (key, rows) before any shuffle: a key holding a third of all rows becomes
    one row per task, and only distinct keys cross the network.
    """
    keys = (child.where(F.col(child_key).isNotNull())
            .groupBy(F.col(child_key).alias("_k"))
            .agg(F.count(F.lit(1)).alias("_rows")))
    parents = parent.select(F.col(parent_key).alias("_k")).where(F.col("_k").isNotNull())
    # measured on the keys as they are; making them distinct first would cost a shuffle
    small = is_small(parents) if broadcast_parent is None else broadcast_parent
    parents = F.broadcast(parents) if small else parents.distinct()
    return keys.join(parents, "_k", "left_anti").select(F.col("_k").alias(child_key), "_rows")
