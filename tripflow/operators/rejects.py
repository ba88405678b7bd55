"""Reject accounting: audit counts (I5) and labelled anomaly rows.

Both read the raw feeds through ``classify``. The audit is one global
aggregate per feed: a partial aggregate per task, one tiny final row per
feed, so a feed of any size costs one scan of the eight columns the checks
touch. A global aggregate also yields its row for an empty feed (counts 0,
percentage NULL), which a grouped aggregate would not.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.exprs import round_half_away
from tripflow.operators.classify import FEEDS, FLAG_COLUMNS, any_flag, classify
from tripflow.sources import schemas as S

FEED_ORDER = ("yellow", "green", "hvfhv")


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def audit_feed(raw: DataFrame, vehicle_class: str) -> DataFrame:
    """One audit row for one feed: totals, valid count and six reason counts.

    A row may count under several reasons; ``valid_rows`` uses the staging
    filter itself, so rows that are neither valid nor flagged (NULL fare)
    still count as rejected.
    """
    c = classify(raw, FEEDS[vehicle_class])
    counts = c.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("valid")).alias("valid_rows"),
        *[F.count_if(F.col(f)).alias(f) for f in FLAG_COLUMNS],
    )
    rejected = F.col("total_rows") - F.col("valid_rows")
    return counts.select(
        F.lit(vehicle_class).alias("vehicle_class"),
        "total_rows",
        "valid_rows",
        rejected.alias("rejected_rows"),
        # double arithmetic (100.0 is a double literal, not a decimal)
        round_half_away(F.lit(100.0) * rejected / F.nullif(F.col("total_rows"), F.lit(0)), 2)
        .alias("rejection_pct"),
        *FLAG_COLUMNS,
    )


def reject_audit(raws: dict[str, DataFrame]) -> DataFrame:
    """One row per vehicle class, in feed order."""
    return _union([audit_feed(raws[v], v) for v in FEED_ORDER if v in raws]).select(*S.AUDIT_COLUMNS)


def anomalies_feed(raw: DataFrame, vehicle_class: str) -> DataFrame:
    c = classify(raw, FEEDS[vehicle_class])
    return c.where(any_flag()).select(
        "vehicle_class", "vendor_id", "pickup_at", "dropoff_at", "pickup_zone_id",
        "dropoff_zone_id", "fare_amount", F.col("audit_total_amount").alias("total_amount"),
        "trip_distance_miles", "rejection_reason",
    )


def trip_anomalies(raws: dict[str, DataFrame]) -> DataFrame:
    """Every raw row failing at least one check, with its first reason."""
    return _union([anomalies_feed(raws[v], v) for v in FEED_ORDER if v in raws])


def unlabelled_rejects(raws: dict[str, DataFrame]) -> DataFrame:
    """Rows the staging filter drops that no check labels (NULL fare or total).

    These explain ``rejected_rows - count(anomalies)`` per class; one row per class.
    """
    frames = []
    for v in FEED_ORDER:
        if v not in raws:
            continue
        c = classify(raws[v], FEEDS[v])
        lost = F.coalesce(~F.col("valid"), F.lit(True)) & ~F.coalesce(any_flag(), F.lit(False))
        frames.append(c.agg(F.count_if(lost).alias("unlabelled_rows"))
                      .select(F.lit(v).alias("vehicle_class"), "unlabelled_rows"))
    return _union(frames)
