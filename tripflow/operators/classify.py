"""Per-feed mapping and the shared classification projection.

One ``FeedSpec`` per raw feed describes, as data, how raw columns become
staged columns and which raw columns feed the six rejection checks. From it
``classify`` builds a single narrow projection carrying

* the staged columns (renamed, cast, surrogate key),
* the six rejection flags (``failed_*``) with the reference's three-valued logic,
* ``valid`` (the staging filter, nullable on purpose: NULL drops the row) and
* ``rejection_reason`` (first failing check in priority order).

Staging, the anomaly table and the reject audit are all filters or
aggregates over this projection, so the rules exist once. The flags are
**not** ``NOT valid``: a NULL fare makes ``valid`` NULL (row dropped) while
its flags stay NULL/false (row in no anomaly list).
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.exprs import surrogate_key, to_int_half_even
from tripflow.sources import schemas as S

# Source of a staged column: a raw column name (cast to the target type),
# ``NULL`` (typed NULL), a ``Lit`` or a function of the raw DataFrame.
NULL = None


@dataclass(frozen=True)
class Lit:
    value: object


Source = str | Lit | None | Callable[[DataFrame], Column]


@dataclass(frozen=True)
class FeedSpec:
    vehicle_class: str
    raw_schema: T.StructType
    key_fields: tuple[str, ...]
    pickup: str
    dropoff: str
    fare: str
    distance: str
    pickup_zone: str
    dropoff_zone: str
    # total used by the staging filter and the staged column
    staged_total: Callable[[DataFrame], Column]
    # total used by the rejection flag and the anomaly row
    audit_total: Callable[[DataFrame], Column]
    staged: tuple[tuple[str, Source, T.DataType], ...] = field(default=())


def cast_to(df: DataFrame, name: str, target: T.DataType) -> Column:
    """``cast(raw as target)`` with the reference's double -> integer rounding."""
    src = df.schema[name].dataType
    c = F.col(name)
    if isinstance(target, T.IntegerType) and isinstance(src, (T.DoubleType, T.FloatType, T.DecimalType)):
        return to_int_half_even(c.cast("double"))
    if isinstance(target, T.TimestampNTZType):
        return c.cast(T.TimestampNTZType())
    return c if src == target else c.cast(target)


def _dbl(df: DataFrame, name: str) -> Column:
    return cast_to(df, name, S.D)


def _hvfhv_total(coalesce_base: bool) -> Callable[[DataFrame], Column]:
    """Ride-hail total: base fare plus surcharges and tips, each NULL as 0.

    Staging keeps a NULL base (NULL total, row dropped); the audit and the
    anomaly rows coalesce the base to 0 as well. Summed left to right, as written.
    """
    parts = ("tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips")

    def build(df: DataFrame) -> Column:
        base = _dbl(df, "base_passenger_fare")
        total = F.coalesce(base, F.lit(0.0)) if coalesce_base else base
        for p in parts:
            total = total + F.coalesce(_dbl(df, p), F.lit(0.0))
        return total

    return build


def _metered_total(df: DataFrame) -> Column:
    return _dbl(df, "total_amount")


YELLOW = FeedSpec(
    vehicle_class="yellow",
    raw_schema=S.YELLOW_RAW,
    key_fields=("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                "PULocationID", "DOLocationID", "total_amount"),
    pickup="tpep_pickup_datetime", dropoff="tpep_dropoff_datetime",
    fare="fare_amount", distance="trip_distance",
    pickup_zone="PULocationID", dropoff_zone="DOLocationID",
    staged_total=_metered_total, audit_total=_metered_total,
    staged=(
        ("pickup_at", "tpep_pickup_datetime", S.TS),
        ("dropoff_at", "tpep_dropoff_datetime", S.TS),
        ("pickup_zone_id", "PULocationID", S.I),
        ("dropoff_zone_id", "DOLocationID", S.I),
        ("fare_amount", "fare_amount", S.D),
        ("tip_amount", "tip_amount", S.D),
        ("total_amount", _metered_total, S.D),
        ("vendor_id", "VendorID", S.I),
        ("vehicle_class", Lit("yellow"), S.S),
        ("passenger_count", "passenger_count", S.I),
        ("trip_distance_miles", "trip_distance", S.D),
        ("rate_code_id", "RatecodeID", S.I),
        ("payment_type", "payment_type", S.I),
        ("extra", "extra", S.D),
        ("mta_tax", "mta_tax", S.D),
        ("tolls_amount", "tolls_amount", S.D),
        ("improvement_surcharge", "improvement_surcharge", S.D),
        ("congestion_surcharge", "congestion_surcharge", S.D),
        ("airport_fee", "Airport_fee", S.D),
        ("store_and_fwd_flag", "store_and_fwd_flag", S.S),
    ),
)

GREEN = FeedSpec(
    vehicle_class="green",
    raw_schema=S.GREEN_RAW,
    key_fields=("VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime",
                "PULocationID", "DOLocationID", "total_amount"),
    pickup="lpep_pickup_datetime", dropoff="lpep_dropoff_datetime",
    fare="fare_amount", distance="trip_distance",
    pickup_zone="PULocationID", dropoff_zone="DOLocationID",
    staged_total=_metered_total, audit_total=_metered_total,
    staged=(
        ("pickup_at", "lpep_pickup_datetime", S.TS),
        ("dropoff_at", "lpep_dropoff_datetime", S.TS),
        ("pickup_zone_id", "PULocationID", S.I),
        ("dropoff_zone_id", "DOLocationID", S.I),
        ("fare_amount", "fare_amount", S.D),
        ("tip_amount", "tip_amount", S.D),
        ("total_amount", _metered_total, S.D),
        ("vendor_id", "VendorID", S.I),
        ("vehicle_class", Lit("green"), S.S),
        ("passenger_count", "passenger_count", S.I),
        ("trip_distance_miles", "trip_distance", S.D),
        ("rate_code_id", "RatecodeID", S.I),
        ("payment_type", "payment_type", S.I),
        ("trip_type", "trip_type", S.I),
        ("extra", "extra", S.D),
        ("mta_tax", "mta_tax", S.D),
        ("tolls_amount", "tolls_amount", S.D),
        ("improvement_surcharge", "improvement_surcharge", S.D),
        ("congestion_surcharge", "congestion_surcharge", S.D),
        ("airport_fee", NULL, S.D),
        ("store_and_fwd_flag", "store_and_fwd_flag", S.S),
    ),
)

HVFHV = FeedSpec(
    vehicle_class="hvfhv",
    raw_schema=S.HVFHV_RAW,
    key_fields=("hvfhs_license_num", "pickup_datetime", "dropoff_datetime",
                "PULocationID", "DOLocationID", "base_passenger_fare"),
    pickup="pickup_datetime", dropoff="dropoff_datetime",
    fare="base_passenger_fare", distance="trip_miles",
    pickup_zone="PULocationID", dropoff_zone="DOLocationID",
    staged_total=_hvfhv_total(coalesce_base=False),
    audit_total=_hvfhv_total(coalesce_base=True),
    staged=(
        ("pickup_at", "pickup_datetime", S.TS),
        ("dropoff_at", "dropoff_datetime", S.TS),
        ("pickup_zone_id", "PULocationID", S.I),
        ("dropoff_zone_id", "DOLocationID", S.I),
        ("fare_amount", "base_passenger_fare", S.D),
        ("tip_amount", "tips", S.D),
        ("total_amount", _hvfhv_total(coalesce_base=False), S.D),
        ("vendor_id", NULL, S.I),
        ("vehicle_class", Lit("hvfhv"), S.S),
        ("passenger_count", NULL, S.I),
        ("trip_distance_miles", "trip_miles", S.D),
        ("trip_time_seconds", "trip_time", S.I),
        ("hvfhs_license_num", "hvfhs_license_num", S.S),
        ("dispatching_base_num", "dispatching_base_num", S.S),
        ("originating_base_num", "originating_base_num", S.S),
        ("request_at", "request_datetime", S.TS),
        ("on_scene_at", "on_scene_datetime", S.TS),
        ("tolls_amount", "tolls", S.D),
        ("bcf", "bcf", S.D),
        ("sales_tax", "sales_tax", S.D),
        ("congestion_surcharge", "congestion_surcharge", S.D),
        ("airport_fee", "airport_fee", S.D),
        ("driver_pay", "driver_pay", S.D),
        ("shared_request_flag", "shared_request_flag", S.S),
        ("shared_match_flag", "shared_match_flag", S.S),
        ("access_a_ride_flag", "access_a_ride_flag", S.S),
        ("wav_request_flag", "wav_request_flag", S.S),
        ("wav_match_flag", "wav_match_flag", S.S),
    ),
)

FEEDS: dict[str, FeedSpec] = {s.vehicle_class: s for s in (YELLOW, GREEN, HVFHV)}

# Rejection reasons in label priority order, with their flag columns.
REASONS: tuple[tuple[str, str], ...] = (
    ("invalid_timestamps", "failed_timestamp"),
    ("null_pickup_zone", "failed_null_pickup_zone"),
    ("null_dropoff_zone", "failed_null_dropoff_zone"),
    ("negative_fare", "failed_neg_fare"),
    ("negative_total", "failed_neg_total"),
    ("zero_distance", "failed_zero_distance"),
)
FLAG_COLUMNS = [
    "failed_timestamp", "failed_neg_fare", "failed_neg_total", "failed_zero_distance",
    "failed_null_pickup_zone", "failed_null_dropoff_zone",
]


def _memo_columns(fn):
    """Reuse the (unresolved, immutable) expressions built for one feed schema.

    Building a Column costs a py4j round trip per function call; a feed's
    staging projection is hundreds of them. The expressions depend only on
    the raw schema, so they are built once per Spark application and schema.
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(df: DataFrame, spec: "FeedSpec"):
        key = (df.sparkSession.sparkContext.applicationId, spec.vehicle_class, df.schema.json())
        if key not in cache:
            cache[key] = fn(df, spec)
        return cache[key]
    return wrapper


def _source_column(df: DataFrame, src: Source, target: T.DataType) -> Column:
    if src is NULL:
        return F.lit(None).cast(target)
    if isinstance(src, Lit):
        return F.lit(src.value).cast(target)
    if isinstance(src, str):
        return cast_to(df, src, target)
    return src(df).cast(target)


@_memo_columns
def trip_id(df: DataFrame, spec: FeedSpec) -> Column:
    """Surrogate key over the **raw** key columns, before any cast."""
    return surrogate_key([(c, df.schema[c].dataType) for c in spec.key_fields])


@_memo_columns
def staged_columns(df: DataFrame, spec: FeedSpec) -> list[Column]:
    cols = [trip_id(df, spec).alias("trip_id")]
    cols += [_source_column(df, src, t).alias(name) for name, src, t in spec.staged]
    return cols


@_memo_columns
def flag_columns(df: DataFrame, spec: FeedSpec) -> list[Column]:
    pu, do = F.col(spec.pickup), F.col(spec.dropoff)
    pu_ts, do_ts = cast_to(df, spec.pickup, S.TS), cast_to(df, spec.dropoff, S.TS)
    dist = F.col(spec.distance)
    return [
        ((pu_ts >= do_ts) | pu.isNull() | do.isNull()).alias("failed_timestamp"),
        (_dbl(df, spec.fare) < 0).alias("failed_neg_fare"),
        (spec.audit_total(df) < 0).alias("failed_neg_total"),
        ((_dbl(df, spec.distance) <= 0) | dist.isNull()).alias("failed_zero_distance"),
        F.col(spec.pickup_zone).isNull().alias("failed_null_pickup_zone"),
        F.col(spec.dropoff_zone).isNull().alias("failed_null_dropoff_zone"),
    ]


@_memo_columns
def valid_predicate(df: DataFrame, spec: FeedSpec) -> Column:
    """The staging filter (B8), on the staged casts. NULL means the row is dropped."""
    return (
        (cast_to(df, spec.pickup, S.TS) < cast_to(df, spec.dropoff, S.TS))
        & (_dbl(df, spec.fare) >= 0)
        & (spec.staged_total(df) >= 0)
        & (_dbl(df, spec.distance) > 0)
        & F.col(spec.pickup_zone).isNotNull()
        & F.col(spec.dropoff_zone).isNotNull()
    )


def any_flag(flags: list[Column] | None = None) -> Column:
    """Disjunction of the six flags (B10); NULL or false drops the row."""
    cols = flags if flags is not None else [F.col(c) for c in FLAG_COLUMNS]
    return functools.reduce(operator.or_, cols)


def reason_column() -> Column:
    """First failing check in priority order (B11); NULL when none is true."""
    expr = None
    for label, flag in REASONS:
        expr = (F.when(F.col(flag), F.lit(label)) if expr is None
                else expr.when(F.col(flag), F.lit(label)))
    return expr


def classify(raw: DataFrame, spec: FeedSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Raw feed -> staged columns + flags + ``valid`` + ``rejection_reason``, and the raw columns to ``keep``.

    Narrow (no shuffle). Columns a consumer does not use are pruned by Catalyst,
    so the audit never computes the md5 key and staging never computes flags.
    """
    return raw.select(*_classified_columns(raw, spec), *keep).withColumn("rejection_reason", reason_column())


@_memo_columns
def _classified_columns(raw: DataFrame, spec: FeedSpec) -> list[Column]:
    return [*staged_columns(raw, spec), *flag_columns(raw, spec),
            valid_predicate(raw, spec).alias("valid"),
            spec.audit_total(raw).alias("audit_total_amount")]
