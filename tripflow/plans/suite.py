"""The check suite of the model tables, as data: 112 column checks + 2 singular.

Table names are the model names of ``plans.models``; ``tables`` dicts passed to
``run_checks`` use the same names.
"""

from __future__ import annotations

from tripflow.plans.checks import ERROR, WARN, Check

STG_YELLOW, STG_GREEN, STG_HVFHV = "stg_yellow_trips", "stg_green_trips", "stg_hvfhv_trips"
STG_ZONES, UNIFIED, ANOMALIES = "stg_zone_lookup", "int_trips_unified", "int_trip_anomalies"
DIM_ZONES, DIM_DATE, DIM_CLASS, DIM_PAYMENT = "dim_zones", "dim_date", "dim_vehicle_class", "dim_payment_types"
FACT = "fct_trips"

# Accepted value lists.
VENDORS_YELLOW = (1, 2, 6)
VENDORS_GREEN = (1, 2)
RATE_CODES = (1, 2, 3, 4, 5, 6)
PAYMENT_CODES = (0, 1, 2, 3, 4, 5, 6)
TRIP_TYPES = (1, 2)
HV_LICENSES = ("HV0002", "HV0003", "HV0004", "HV0005")
BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown", "N/A")
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports", "EWR", "N/A")
BOROUGH_GROUPS = ("Airport", "Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "Other / Unknown")
CLASSES = ("yellow", "green", "hvfhv")
REJECTION_REASONS = ("invalid_timestamps", "null_pickup_zone", "null_dropoff_zone",
                     "negative_fare", "negative_total", "zero_distance")


def not_null(model: str, *cols: str, severity: str = ERROR) -> list[Check]:
    return [Check(f"not_null.{model}.{c}", "not_null", model, (c,), severity=severity) for c in cols]


def unique(model: str, col: str, severity: str = ERROR) -> Check:
    return Check(f"unique.{model}.{col}", "unique", model, (col,), severity=severity)


def accepted(model: str, col: str, values: tuple, severity: str = ERROR) -> Check:
    return Check(f"accepted_values.{model}.{col}", "accepted_values", model, (col,),
                 values=values, severity=severity)


def rel(model: str, col: str, to: str, field: str, severity: str = ERROR) -> Check:
    return Check(f"relationships.{model}.{col}", "relationships", model, (col,),
                 to=to, field=field, severity=severity)


def unique_combo(model: str, *cols: str) -> Check:
    return Check(f"unique_combination.{model}", "unique_combination", model, tuple(cols))


_TRIP_NOT_NULL = ("trip_id", "pickup_at", "dropoff_at", "pickup_zone_id", "dropoff_zone_id",
                  "fare_amount", "tip_amount", "total_amount")


def staged_trip_checks() -> list[Check]:
    out: list[Check] = []
    out += not_null(STG_YELLOW, *_TRIP_NOT_NULL, "vendor_id", "vehicle_class", "trip_distance_miles")
    out += [unique(STG_YELLOW, "trip_id", WARN),
            rel(STG_YELLOW, "pickup_zone_id", STG_ZONES, "location_id"),
            rel(STG_YELLOW, "dropoff_zone_id", STG_ZONES, "location_id"),
            accepted(STG_YELLOW, "vendor_id", VENDORS_YELLOW),
            accepted(STG_YELLOW, "vehicle_class", ("yellow",)),
            accepted(STG_YELLOW, "rate_code_id", RATE_CODES, WARN),
            accepted(STG_YELLOW, "payment_type", PAYMENT_CODES, WARN)]
    out += not_null(STG_GREEN, *_TRIP_NOT_NULL, "vendor_id", "vehicle_class", "trip_distance_miles")
    out += [unique(STG_GREEN, "trip_id"),
            rel(STG_GREEN, "pickup_zone_id", STG_ZONES, "location_id"),
            rel(STG_GREEN, "dropoff_zone_id", STG_ZONES, "location_id"),
            accepted(STG_GREEN, "vendor_id", VENDORS_GREEN),
            accepted(STG_GREEN, "vehicle_class", ("green",)),
            accepted(STG_GREEN, "rate_code_id", RATE_CODES, WARN),
            accepted(STG_GREEN, "payment_type", PAYMENT_CODES, WARN),
            accepted(STG_GREEN, "trip_type", TRIP_TYPES, WARN)]
    out += not_null(STG_HVFHV, *_TRIP_NOT_NULL, "vehicle_class", "trip_distance_miles", "hvfhs_license_num")
    out += [unique(STG_HVFHV, "trip_id", WARN),
            rel(STG_HVFHV, "pickup_zone_id", STG_ZONES, "location_id"),
            rel(STG_HVFHV, "dropoff_zone_id", STG_ZONES, "location_id"),
            accepted(STG_HVFHV, "vehicle_class", ("hvfhv",)),
            accepted(STG_HVFHV, "hvfhs_license_num", HV_LICENSES, WARN)]
    out += not_null(STG_ZONES, "location_id", "borough", "zone_name", "service_zone")
    out += [unique(STG_ZONES, "location_id"),
            accepted(STG_ZONES, "borough", BOROUGHS),
            accepted(STG_ZONES, "service_zone", SERVICE_ZONES, WARN)]
    return out


def intermediate_checks() -> list[Check]:
    out = [unique_combo(UNIFIED, "trip_id", "vehicle_class")]
    out += not_null(UNIFIED, "trip_id", "vehicle_class", "pickup_at", "dropoff_at", "pickup_date",
                    "pickup_zone_id", "dropoff_zone_id", "fare_amount", "total_amount")
    out += [accepted(UNIFIED, "vehicle_class", CLASSES),
            rel(UNIFIED, "pickup_zone_id", DIM_ZONES, "location_id"),
            rel(UNIFIED, "dropoff_zone_id", DIM_ZONES, "location_id")]
    out += not_null(ANOMALIES, "vehicle_class", "rejection_reason")
    out += [accepted(ANOMALIES, "vehicle_class", CLASSES),
            accepted(ANOMALIES, "rejection_reason", REJECTION_REASONS)]
    return out


def mart_checks() -> list[Check]:
    out = not_null(DIM_ZONES, "location_id", "zone_name", "borough", "service_zone", "borough_group")
    out += [unique(DIM_ZONES, "location_id"),
            accepted(DIM_ZONES, "borough", BOROUGHS),
            accepted(DIM_ZONES, "borough_group", BOROUGH_GROUPS)]
    out += not_null(DIM_DATE, "date_day", "is_weekend") + [unique(DIM_DATE, "date_day")]
    out += not_null(DIM_CLASS, "vehicle_class", "display_name", "is_rideshare")
    out += [unique(DIM_CLASS, "vehicle_class"), accepted(DIM_CLASS, "vehicle_class", CLASSES)]
    out += not_null(DIM_PAYMENT, "payment_type_id", "payment_label", "is_cashless")
    out += [unique(DIM_PAYMENT, "payment_type_id")]
    out += [unique_combo(FACT, "trip_id", "vehicle_class")]
    out += not_null(FACT, "trip_id", "vehicle_class", "pickup_date", "pickup_zone_id", "dropoff_zone_id",
                    "payment_type_id", "fare_amount", "total_amount", "is_rideshare")
    out += [rel(FACT, "vehicle_class", DIM_CLASS, "vehicle_class"),
            rel(FACT, "pickup_date", DIM_DATE, "date_day", WARN),
            rel(FACT, "pickup_zone_id", DIM_ZONES, "location_id"),
            rel(FACT, "dropoff_zone_id", DIM_ZONES, "location_id"),
            rel(FACT, "payment_type_id", DIM_PAYMENT, "payment_type_id")]
    return out


def singular_checks(as_of=None) -> list[Check]:
    return [
        Check("singular.no_future_trips", "singular", FACT, severity=ERROR,
              params={"test": "no_future_trips", "as_of": as_of}),
        Check("singular.total_equals_components", "singular", FACT, severity=WARN,
              params={"test": "total_equals_components"}),
    ]


def full_suite(as_of=None) -> list[Check]:
    """All 114 checks."""
    return staged_trip_checks() + intermediate_checks() + mart_checks() + singular_checks(as_of)
