"""Incremental fact load with delete+insert on ``(trip_id, vehicle_class)``.

Two forms share the same rules:

* ``merge_increment`` / ``incremental_fact`` are pure DataFrame plans
  (left-anti on the batch keys, then union), usable on any target DataFrame.
* ``upsert_fact_table`` applies them to a Parquet table partitioned by
  ``pickup_date``. A key hashes the raw pick-up time, so each key lives in
  exactly one date partition: only the partitions the batch touches are read,
  merged and replaced. The merged partitions are written once and moved into
  place under a manifest (``operators.partitioned``), so a run that dies at any
  point is finished, or leaves no trace, when the next run starts.

Batch selection (B14), faithful to the reference: ``pickup_date >
max(target.pickup_date) - 1 day``. Consequences kept on purpose: a late row
dated two days before the max is never loaded; one future-dated row freezes
loading; an empty target loads nothing. ``lookback_days`` widens the window,
``ignore_after`` computes the max only over rows picked up at or before it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.fact import build_fact
from tripflow.operators.partitioned import PartitionedTable
from tripflow.sources.schemas import FACT, FACT_COLUMNS, TRIP_KEY

PARTITION_COLUMN = "pickup_date"


def max_loaded_date(target: DataFrame, ignore_after: dt.datetime | str | None = None) -> Column:
    """``max(pickup_date)`` of the target as a scalar subquery column (NULL if empty)."""
    t = target
    if ignore_after is not None:
        t = t.where(picked_up_by(ignore_after))
    return t.select(F.max(PARTITION_COLUMN)).scalar()


def picked_up_by(moment: dt.datetime | str) -> Column:
    """Picked up at or before ``moment``. The date condition follows from the other one; it is
    stated so that later partitions are not read."""
    m = F.lit(str(moment)).cast("timestamp_ntz")
    return (F.col(PARTITION_COLUMN) <= m.cast("date")) & (F.col("pickup_at") <= m)


def batch_filter(max_date: Column | dt.date, lookback_days: int = 1) -> Column:
    """Rows dated after ``max_date - lookback_days``; NULL max keeps nothing."""
    m = max_date if isinstance(max_date, Column) else F.lit(max_date)
    return F.col(PARTITION_COLUMN) > F.date_sub(m, lookback_days)


def kept_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target rows whose key is not in the batch."""
    return target.join(batch.select(*TRIP_KEY), TRIP_KEY, "left_anti").select(*FACT_COLUMNS)


def merge_increment(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Delete target rows whose key is in the batch, then append the batch."""
    return kept_rows(target, batch).unionByName(batch.select(*FACT_COLUMNS))


def incremental_fact(target: DataFrame, trips: DataFrame, zones: DataFrame, classes: DataFrame,
                     lookback_days: int = 1, ignore_after=None) -> DataFrame:
    """Pure-plan incremental build: the target after one delete+insert run.

    A key lives in one date, so target rows of dates that the batch cannot hold are passed on without a
    join, and batch rows behind the target's newest date find nothing to delete.
    """
    m = max_loaded_date(target, ignore_after)
    selected = batch_filter(m, lookback_days)
    batch = build_fact(trips.where(selected), zones, classes)
    # the newest date of all is known only if the maximum leaves no row out
    meets = batch if ignore_after is not None else batch.where(F.col(PARTITION_COLUMN) <= m)
    older = target.where(~F.coalesce(selected, F.lit(False))).select(*FACT_COLUMNS)
    return older.unionByName(kept_rows(target.where(selected), meets)).unionByName(batch.select(*FACT_COLUMNS))


def newest_loaded_date(table: PartitionedTable, target: DataFrame, ignore_after=None) -> str | None:
    """C5 on the written table: its newest date that holds a row, none if there is none.

    The dates come from the listing. A day is read only to see that it has a row, newest first:
    one small job, unless the newest days are empty or beyond ``ignore_after``.
    """
    last = None if ignore_after is None else str(ignore_after)[:10]
    for day in reversed(table.partitions()):
        if last is not None and day > last:
            continue
        rows = target.where(F.col(PARTITION_COLUMN) == F.lit(day).cast("date"))
        if ignore_after is not None:
            rows = rows.where(picked_up_by(ignore_after))
        if not rows.isEmpty():
            return day
    return None


def upsert_fact_table(spark: SparkSession, path: str, trips: DataFrame, zones: DataFrame,
                      classes: DataFrame, lookback_days: int = 1, ignore_after=None, checks=None,
                      cluster: Sequence[str] = (), dealt: bool = False) -> dict:
    """Full build when no table is committed at ``path``, else one delete+insert run.

    ``checks`` (a ``plans.load_checks.LoadChecks``) counts failures in the jobs that write, and keeps
    the table's counts as its state. ``cluster`` lays out the rows of a date by these columns. ``dealt`` says that
    ``trips`` are a table in folders of dates (see ``PartitionedTable``), whose rows are written without a shuffle.

    Returns a small summary dict (mode, max date, batch rows, touched dates; ``finished`` holds the
    summary of a load that an earlier run left open and this one completed first).
    """
    table = PartitionedTable(spark, path, PARTITION_COLUMN, cluster, dealt and not cluster)
    if not table.committed():
        watch, state = checks.of_build() if checks else (None, None)
        if not cluster and not dealt:
            # dealt by date while the rows are narrow, before the dimensions' columns are joined
            trips, table.dealt = trips.hint("rebalance", PARTITION_COLUMN), True
        table.create(build_fact(trips, zones, classes), watch, state)
        return {"mode": "full"}
    finished = table.recover()
    done = {"finished": finished} if finished else {}

    # declared schema: no inference pass, and an empty table still reads
    target = spark.read.schema(FACT).parquet(path)
    newest = newest_loaded_date(table, target, ignore_after)
    if newest is None:
        return {"mode": "incremental", "max_date": None, "batch_rows": 0, "dates": [], **done}

    selected = trips.where(batch_filter(dt.date.fromisoformat(newest), lookback_days))
    # calendar days: a bounded, small list even for 100 TB of trips
    per_day = {str(r[0]): r[1] for r in build_fact(selected, zones, classes).groupBy(PARTITION_COLUMN).count().collect()}
    info = {"mode": "incremental", "max_date": newest, "batch_rows": sum(per_day.values()), "dates": sorted(per_day)}
    if per_day:
        # a key lives in one date: only days that the table holds have rows to delete
        held = [dt.date.fromisoformat(d) for d in sorted(set(per_day) & set(table.partitions()))]
        here = F.col(PARTITION_COLUMN).isin(held)
        old = target.where(F.col(PARTITION_COLUMN).isin([dt.date.fromisoformat(d) for d in per_day]))
        watch, state = None, None
        if checks:
            old, watch, state = checks.of_load(table.state(), old, info["dates"], empty=table.dealt and not held)
        kept = kept_rows(old, selected.where(here))
        batch = build_fact(selected, zones, classes).select(*FACT_COLUMNS)
        rows = kept.unionByName(batch)
        if table.dealt:
            # the join deals by the key, so its days are dealt by date again, and the new ones stay as they are
            mixed = kept.unionByName(batch.where(here)).hint("rebalance", PARTITION_COLUMN)
            rows = mixed.unionByName(batch.where(~here)) if held else batch
        table.replace(rows, info, watch, state)
    return {**info, **done}
