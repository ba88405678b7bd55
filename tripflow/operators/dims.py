"""Dimensions I8-I11: zones, calendar, vehicle class, payment type.

All four are small and bounded: the zone table by the lookup file, the
calendar by its two dates, the other two by literal rows in this file.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.functions.exprs import iso_dow
from tripflow.sources.readers import date_spine, literal_relation

# Airport name patterns (case-insensitive), then the boroughs
# that keep their own group; anything else is "Other / Unknown".
AIRPORT_PATTERNS = ("%airport%", "%jfk%", "%laguardia%", "%newark%")
OWN_GROUP_BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")
AIRPORT_GROUP = "Airport"
OTHER_GROUP = "Other / Unknown"

# Calendar range of the date dimension (end exclusive).
DATE_START = dt.date(2023, 12, 1)
DATE_END = dt.date(2025, 1, 1)

# Vehicle classes (class, display name, is_rideshare).
VEHICLE_CLASSES = [
    ("yellow", "Yellow Taxi", False),
    ("green", "Green Taxi", False),
    ("hvfhv", "Uber / Lyft (TNC)", True),
]

# Payment codes (id, label, is_cashless); 0 is the ride-hail catch-all.
PAYMENT_TYPES = [
    (1, "Credit Card", True),
    (2, "Cash", False),
    (3, "No Charge", False),
    (4, "Dispute", False),
    (5, "Unknown", False),
    (6, "Voided Trip", False),
    (0, "N/A (Rideshare)", True),
]


def borough_group(zone_name: str = "zone_name", borough: str = "borough"):
    """Airports by zone name first; a NULL name falls through to the borough."""
    z, b = F.col(zone_name), F.col(borough)
    airport = None
    for p in AIRPORT_PATTERNS:
        cond = z.ilike(p)
        airport = cond if airport is None else (airport | cond)
    expr = F.when(airport, F.lit(AIRPORT_GROUP))
    for name in OWN_GROUP_BOROUGHS:
        expr = expr.when(b == name, F.lit(name))
    return expr.otherwise(F.lit(OTHER_GROUP))


def dim_zones(zones: DataFrame) -> DataFrame:
    """I8: staged zone lookup plus ``borough_group``."""
    return zones.select("location_id", "zone_name", "borough", "service_zone",
                        borough_group().alias("borough_group"))


def calendar_attributes() -> list[Column]:
    """The attributes of ``date_day``."""
    d = F.col("date_day")
    return [
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_dow(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.trunc(d, "week").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
    ]


def dim_date(spark: SparkSession, start: dt.date | str = DATE_START,
             end: dt.date | str = DATE_END) -> DataFrame:
    """Calendar attributes for each day in [start, end)."""
    return date_spine(spark, start, end).select(*calendar_attributes())


def filled_days(days: DataFrame, day: str = "pickup_date", group: str = "vehicle_class", count: str = "trips") -> DataFrame:
    """A4 bounded by the data: counts per day and group, with 0 for the days of a group without a row,
    from the first to the last day of all groups.

    Each counted day is spread up to the next one of its group, so no spine is joined. The windows
    run over counted days: their number is bounded by the calendar, whatever the number of trips.
    """
    own, every = Window.partitionBy(group).orderBy(day), Window.partitionBy()
    bounds = days.select("*", F.lag(day).over(own).alias("_before"), F.lead(day).over(own).alias("_next"),
                         F.min(day).over(every).alias("_first"), F.max(day).over(every).alias("_last"))
    start = F.when(F.col("_before").isNull(), F.col("_first")).otherwise(F.col(day))
    end = F.coalesce(F.date_sub("_next", 1), F.col("_last"))
    spread = bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("date_day"), group,
                           F.col(day).alias("_day"), count)
    return spread.select("date_day", group, F.when(F.col("date_day") == F.col("_day"), F.col(count)).otherwise(0).alias(count))


def calendar_counts(days: DataFrame) -> DataFrame:
    """Trips per day and class with the calendar attributes of the day, gaps filled."""
    return filled_days(days).select(*calendar_attributes(), "vehicle_class", "trips")


def dim_vehicle_class(spark: SparkSession) -> DataFrame:
    """I10."""
    return literal_relation(spark, VEHICLE_CLASSES,
                            "vehicle_class string, display_name string, is_rideshare boolean")


def dim_payment_types(spark: SparkSession) -> DataFrame:
    """I11."""
    return literal_relation(spark, PAYMENT_TYPES,
                            "payment_type_id int, payment_label string, is_cashless boolean")
