"""Union the three staged feeds on the canonical schema and keep one row per key.

Dedup is ``row_number() = 1`` over ``(trip_id, vehicle_class)``. Catalyst
turns the filter on the rank into a partial ``WindowGroupLimit`` before the
hash exchange and a final one after it, so every task forwards at most one
row per key: a key re-delivered millions of times shuffles at most one row
per map task. md5 keys spread evenly over the shuffle partitions.

The reference orders copies by ``pickup_at`` only, which is part of the
hashed key, so every tie is a full tie and the surviving copy is arbitrary.
Here the order is total: ``pickup_at``, then ``tip_amount`` and every other
canonical column, ascending with NULLs last (the reference engine's default
NULL order), so reruns and the oracle keep the same copy.

``first_by_day`` is the same rule for rows that are then written by day: dealt by day (a large one in several
parts, told by the key), they are deduplicated where they are written, so they cross one shuffle instead of two.
That shuffle carries every copy, so keys with very many are found by counting first, and go through
``keep_first`` before.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tripflow.sources.schemas import CANONICAL, CANONICAL_COLUMNS, TRIP_KEY

_NULL_INT, _NULL_DBL = "int", "double"

# per-class canonical projection: column -> source expression in the staged table
_HVFHV_NULLS = {"payment_type": _NULL_INT, "rate_code_id": _NULL_INT, "extra": _NULL_DBL,
                "mta_tax": _NULL_DBL, "improvement_surcharge": _NULL_DBL}

# Tie-break after pickup_at; the key columns themselves cannot break ties.
DEDUP_ORDER = ["pickup_at", "tip_amount"] + [
    c for c in CANONICAL_COLUMNS
    if c not in ("trip_id", "vehicle_class", "pickup_at", "tip_amount", "pickup_date")
]

# Rows of a day that one task deduplicates and writes; a day is counted in so many cells to find crowded ones
PART_ROWS = 1 << 19
CELLS = 64


def canonical(staged: DataFrame, vehicle_class: str) -> DataFrame:
    """Staged feed -> canonical trip columns, with ``pickup_date``."""
    return staged.select(*canonical_columns(vehicle_class))


def canonical_columns(vehicle_class: str) -> list[Column]:
    """The canonical trip columns over a staged (or classified) feed of one class."""
    types = {f.name: f.dataType for f in CANONICAL.fields}
    cols: list[Column] = []
    for name in CANONICAL_COLUMNS:
        if name == "pickup_date":
            cols.append(F.col("pickup_at").cast("date").alias(name))
        elif vehicle_class == "hvfhv" and name in _HVFHV_NULLS:
            cols.append(F.lit(None).cast(types[name]).alias(name))
        else:
            cols.append(F.col(name).cast(types[name]).alias(name))
    return cols


def dedup_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in DEDUP_ORDER]


def keep_first(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per key, the first in ``dedup_order``.

    The pick-up date follows from the key, which hashes the pick-up time. Partitioning by it as well
    changes no group, and lets Spark move a filter on the date below the window and its shuffle: a
    load of a few days deduplicates only those days.
    """
    w = Window.partitionBy(*(keys or [*TRIP_KEY, "pickup_date"])).orderBy(*dedup_order())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _cell() -> Column:
    """The cell of a row in its day. The key hashes the pick-up time, so a key's copies are in one cell."""
    return F.pmod(F.xxhash64("pickup_at"), F.lit(CELLS))


def day_sizes(trips: DataFrame, part_rows: int = PART_ROWS) -> list[Row]:
    """(pickup_date, rows, crowded) of each day: calendar days, a bounded list.

    ``crowded`` are the cells with far more rows than their share, as a key that is delivered over and over
    makes one. Only the pick-up times are read, and counts are shuffled.
    """
    cells = trips.groupBy("pickup_date", _cell().alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    days = cells.groupBy("pickup_date").agg(F.sum("n").alias("rows"), F.collect_list(F.struct("cell", "n")).alias("cells"))
    crowded = F.filter("cells", lambda c: c["n"] > 2 * F.col("rows") / CELLS + part_rows)
    return days.select("pickup_date", "rows", F.transform(crowded, lambda c: c["cell"]).alias("crowded")).collect()


def first_by_day(trips: DataFrame, days: Sequence[Row], part_rows: int = PART_ROWS) -> DataFrame:
    """``keep_first`` over canonical trips, with the rows dealt by day: a task has whole days and parts of large ones.

    ``days`` are the ``day_sizes`` of the trips; only the layout depends on them. The hexadecimal ``trip_id``
    crosses the shuffle as its 16 bytes.
    """
    crowded = [(F.col("pickup_date") == F.lit(d.pickup_date)) & _cell().isin(d.crowded) for d in days if d.crowded]
    if crowded:
        many = F.coalesce(functools.reduce(operator.or_, crowded), F.lit(False))
        trips = trips.where(~many).unionByName(keep_first(trips.where(many)))
    rows, by = trips.withColumn("trip_id", F.unhex("trip_id")), ["pickup_date"]
    large = [(d.pickup_date, -(-d.rows // part_rows)) for d in days if d.rows > part_rows]
    if large:
        parts = F.broadcast(trips.sparkSession.createDataFrame(large, "pickup_date date, _parts long"))
        part = F.coalesce(F.pmod(F.xxhash64("trip_id"), F.col("_parts")), F.lit(0))
        rows, by = rows.join(parts, "pickup_date", "left").withColumn("_part", part), ["pickup_date", "_part"]
    # the window's groups lie within the parts, so it needs no shuffle of its own
    first = keep_first(rows.select(*trips.columns, *by[1:]).repartition(*by), [*TRIP_KEY, *by])
    return first.withColumn("trip_id", F.lower(F.hex("trip_id"))).select(*trips.columns)


def all_trips(yellow: DataFrame, green: DataFrame, hvfhv: DataFrame) -> DataFrame:
    """B12 + G1: the three staged feeds on the canonical schema, with all copies."""
    parts = [canonical(yellow, "yellow"), canonical(green, "green"), canonical(hvfhv, "hvfhv")]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def unify_trips(yellow: DataFrame, green: DataFrame, hvfhv: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """I7 = B12 + G1 + E1 over the three staged feeds; ``keys`` as in ``keep_first``."""
    return keep_first(all_trips(yellow, green, hvfhv), keys)
