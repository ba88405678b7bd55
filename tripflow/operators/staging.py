"""Staging models I1-I4: valid rows of each feed on the staged schema.

The filter is applied to the raw scan and the projection on top, so Catalyst
pushes the null checks and same-type comparisons into the Parquet reader
(``PushedFilters``) and reads only the mapped columns (``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.classify import FEEDS, FeedSpec, cast_to, staged_columns, valid_predicate
from tripflow.sources import schemas as S


def stage(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    return raw.where(valid_predicate(raw, spec)).select(*staged_columns(raw, spec))


def stage_yellow(raw: DataFrame) -> DataFrame:
    return stage(raw, FEEDS["yellow"])


def stage_green(raw: DataFrame) -> DataFrame:
    return stage(raw, FEEDS["green"])


def stage_hvfhv(raw: DataFrame) -> DataFrame:
    return stage(raw, FEEDS["hvfhv"])


def stage_zones(raw: DataFrame) -> DataFrame:
    """I4: rename and cast the zone lookup."""
    return raw.select(
        cast_to(raw, "LocationID", S.I).alias("location_id"),
        F.col("Borough").cast("string").alias("borough"),
        F.col("Zone").cast("string").alias("zone_name"),
        F.col("service_zone").cast("string").alias("service_zone"),
    )
