"""The denormalised trip fact.

The unified trips are joined to three small dimensions (zone twice, in the
pickup and drop-off roles, and vehicle class). Each dimension is broadcast
after a size check, so the fact side never shuffles: the joins run inside
the same codegen stage as the scan and the derived columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.exprs import boundaries_between, iso_dow, round_half_away
from tripflow.operators.joins import sized_broadcast
from tripflow.sources.schemas import FACT_COLUMNS


def fare_per_mile(fare: str = "fare_amount", distance: str = "trip_distance_miles") -> Column:
    """``round(fare / distance, 4)`` when the distance is positive, else NULL."""
    d = F.col(distance)
    return F.when(d > 0, round_half_away(F.col(fare) / d, 4))


def tip_pct(tip: str = "tip_amount", fare: str = "fare_amount") -> Column:
    """``round(100 * tip / fare, 2)`` when the fare is positive, else NULL."""
    f = F.col(fare)
    return F.when(f > 0, round_half_away(F.lit(100.0) * F.col(tip) / f, 2))


def trip_duration_minutes(start: str = "pickup_at", end: str = "dropoff_at") -> Column:
    """Minute boundaries crossed between pick-up and drop-off (BIGINT)."""
    return boundaries_between("minute", start, end)


def build_fact(trips: DataFrame, zones: DataFrame, classes: DataFrame,
               broadcast_dims: bool | None = None) -> DataFrame:
    """Unified trips -> fact rows, in the fact column order.

    ``broadcast_dims=None`` broadcasts each dimension only if it is proven
    small (see ``joins.sized_broadcast``; the vehicle classes are a literal
    relation of fixed size and need no check); ``True`` forces broadcast (for
    dimensions whose size the caller bounds), ``False`` leaves it to Spark.
    """
    def dim(df: DataFrame) -> DataFrame:
        if broadcast_dims is None:
            return sized_broadcast(df)
        return F.broadcast(df) if broadcast_dims else df

    z = dim(zones.select("location_id", "zone_name", "borough"))
    pz = z.select(F.col("location_id").alias("_pz_id"),
                  F.col("zone_name").alias("pickup_zone_name"),
                  F.col("borough").alias("pickup_borough"))
    dz = z.select(F.col("location_id").alias("_dz_id"),
                  F.col("zone_name").alias("dropoff_zone_name"),
                  F.col("borough").alias("dropoff_borough"))
    vc = classes.select(F.col("vehicle_class").alias("_vc"),
                        F.col("display_name").alias("vehicle_display_name"),
                        "is_rideshare")
    vc = vc if broadcast_dims is False else F.broadcast(vc)

    joined = (trips
              .join(pz, F.col("pickup_zone_id") == F.col("_pz_id"), "left")
              .join(dz, F.col("dropoff_zone_id") == F.col("_dz_id"), "left")
              .join(vc, F.col("vehicle_class") == F.col("_vc"), "left"))

    derived = {
        "pickup_hour": F.hour("pickup_at").cast("int"),
        "pickup_dow": iso_dow("pickup_at"),
        "trip_duration_minutes": trip_duration_minutes(),
        "fare_per_mile": fare_per_mile(),
        "tip_pct": tip_pct(),
        "payment_type_id": F.coalesce(F.col("payment_type"), F.lit(0)).cast("int"),
    }
    return joined.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_COLUMNS])
