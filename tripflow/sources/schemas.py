"""Declared schemas: raw feeds, canonical trip, fact.

Raw files are read with these schemas instead of inference, so every monthly
file of a feed lands on the same types (drifting files are cast per file in
``readers.read_feed``). Column names follow the raw files, including the
mixed case ``Airport_fee`` of the yellow feed.
"""

from __future__ import annotations

from pyspark.sql import types as T

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()
DT = T.DateType()
B = T.BooleanType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


YELLOW_RAW = struct(
    ("VendorID", I), ("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS),
    ("passenger_count", D), ("trip_distance", D), ("RatecodeID", I),
    ("PULocationID", I), ("DOLocationID", I), ("payment_type", I),
    ("fare_amount", D), ("extra", D), ("mta_tax", D), ("tip_amount", D),
    ("tolls_amount", D), ("improvement_surcharge", D), ("total_amount", D),
    ("congestion_surcharge", D), ("Airport_fee", D), ("store_and_fwd_flag", S),
)

GREEN_RAW = struct(
    ("VendorID", I), ("lpep_pickup_datetime", TS), ("lpep_dropoff_datetime", TS),
    ("passenger_count", D), ("trip_distance", D), ("RatecodeID", I),
    ("PULocationID", I), ("DOLocationID", I), ("payment_type", I),
    ("fare_amount", D), ("extra", D), ("mta_tax", D), ("tip_amount", D),
    ("tolls_amount", D), ("ehail_fee", D), ("improvement_surcharge", D),
    ("total_amount", D), ("trip_type", I), ("congestion_surcharge", D),
    ("store_and_fwd_flag", S),
)

HVFHV_RAW = struct(
    ("hvfhs_license_num", S), ("dispatching_base_num", S), ("originating_base_num", S),
    ("request_datetime", TS), ("on_scene_datetime", TS), ("pickup_datetime", TS),
    ("dropoff_datetime", TS), ("PULocationID", I), ("DOLocationID", I),
    ("trip_miles", D), ("trip_time", L), ("base_passenger_fare", D), ("tolls", D),
    ("bcf", D), ("sales_tax", D), ("congestion_surcharge", D), ("airport_fee", D),
    ("tips", D), ("driver_pay", D), ("shared_request_flag", S), ("shared_match_flag", S),
    ("access_a_ride_flag", S), ("wav_request_flag", S), ("wav_match_flag", S),
)

ZONE_RAW = struct(("LocationID", I), ("Borough", S), ("Zone", S), ("service_zone", S))

RAW_SCHEMAS = {"yellow": YELLOW_RAW, "green": GREEN_RAW, "hvfhv": HVFHV_RAW, "zone": ZONE_RAW}

# Canonical trip, in the unified table's column order.
CANONICAL = struct(
    ("trip_id", S), ("vehicle_class", S), ("vendor_id", I), ("pickup_at", TS),
    ("dropoff_at", TS), ("pickup_date", DT), ("pickup_zone_id", I), ("dropoff_zone_id", I),
    ("passenger_count", I), ("trip_distance_miles", D), ("fare_amount", D),
    ("tip_amount", D), ("total_amount", D), ("payment_type", I), ("rate_code_id", I),
    ("extra", D), ("mta_tax", D), ("tolls_amount", D), ("improvement_surcharge", D),
    ("congestion_surcharge", D), ("airport_fee", D),
)
CANONICAL_COLUMNS = [f.name for f in CANONICAL.fields]
TRIP_KEY = ["trip_id", "vehicle_class"]

# Fact table, in the reference's column order.
FACT = struct(
    ("trip_id", S), ("vehicle_class", S), ("vendor_id", I), ("pickup_at", TS),
    ("dropoff_at", TS), ("pickup_date", DT), ("pickup_hour", I), ("pickup_dow", I),
    ("trip_duration_minutes", L), ("pickup_zone_id", I), ("dropoff_zone_id", I),
    ("pickup_zone_name", S), ("pickup_borough", S), ("dropoff_zone_name", S),
    ("dropoff_borough", S), ("passenger_count", I), ("trip_distance_miles", D),
    ("fare_per_mile", D), ("fare_amount", D), ("tip_amount", D), ("total_amount", D),
    ("tip_pct", D), ("payment_type_id", I), ("rate_code_id", I), ("tolls_amount", D),
    ("congestion_surcharge", D), ("airport_fee", D), ("extra", D), ("mta_tax", D),
    ("improvement_surcharge", D), ("vehicle_display_name", S), ("is_rideshare", B),
)
FACT_COLUMNS = [f.name for f in FACT.fields]

ANOMALY_COLUMNS = [
    "vehicle_class", "vendor_id", "pickup_at", "dropoff_at", "pickup_zone_id",
    "dropoff_zone_id", "fare_amount", "total_amount", "trip_distance_miles",
    "rejection_reason",
]

AUDIT_COLUMNS = [
    "vehicle_class", "total_rows", "valid_rows", "rejected_rows", "rejection_pct",
    "failed_timestamp", "failed_neg_fare", "failed_neg_total", "failed_zero_distance",
    "failed_null_pickup_zone", "failed_null_dropoff_zone",
]
