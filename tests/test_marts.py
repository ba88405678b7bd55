"""Dedup, dimensions and the fact (I7-I12, traps T6, T10)."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL, plan_nodes, plan_text, raw
from tripflow.operators import dims, staging, unify
from tripflow.operators.fact import build_fact
from tripflow.plans.models import build_models
from tripflow.plans import suite as M
from tripflow.sources.fixtures import raw_feeds


def _unified(spark, yellow=None, green=None, hvfhv=None):
    from conftest import empty
    return unify.unify_trips(staging.stage_yellow(yellow if yellow is not None else empty(spark, "yellow")),
                             staging.stage_green(green if green is not None else empty(spark, "green")),
                             staging.stage_hvfhv(hvfhv if hvfhv is not None else empty(spark, "hvfhv")))


def test_dedup_keeps_lowest_tip(spark):  # E17
    y = raw(spark, "yellow", {"tip_amount": 2.0}, {"tip_amount": 1.0})
    rows = _unified(spark, yellow=y).collect()
    assert len(rows) == 1 and rows[0].tip_amount == 1.0


def test_dedup_plan_limits_before_shuffle(spark):
    y = raw(spark, "yellow", {}, {})
    df = _unified(spark, yellow=y)
    assert plan_nodes(df, "WindowGroupLimit") == 2      # partial (map side) and final
    assert plan_nodes(df, "Exchange") == 1
    assert "hashpartitioning(trip_id" in plan_text(df)


def test_borough_group(spark):  # E16
    z = spark.createDataFrame([(1, "Queens", "jfk x", "Airports"), (2, "Bronx", None, "Boro Zone"),
                               (3, "EWR", "Other", "EWR"), (4, "Manhattan", "Midtown", "Yellow Zone"),
                               (5, "Queens", "LaGuardia Airport", "Airports")],
                              "location_id int, borough string, zone_name string, service_zone string")
    got = {r.location_id: r.borough_group for r in dims.dim_zones(z).collect()}
    assert got == {1: "Airport", 2: "Bronx", 3: "Other / Unknown", 4: "Manhattan", 5: "Airport"}


def test_dim_date(spark):  # E13-E15
    d = dims.dim_date(spark)
    assert d.count() == 397
    r = {x.date_day: x for x in d.collect()}
    sun = r[dt.date(2024, 1, 7)]
    assert (sun.day_of_week, sun.day_name, sun.month_name, sun.week_start, sun.is_weekend) == \
        (7, "Sunday", "January", dt.date(2024, 1, 1), True)
    late = r[dt.date(2024, 12, 30)]
    assert (late.week_of_year, late.year, late.month_start) == (1, 2024, dt.date(2024, 12, 1))
    assert min(r) == dt.date(2023, 12, 1) and max(r) == dt.date(2024, 12, 31)


def test_literal_dims(spark):
    assert dims.dim_vehicle_class(spark).count() == 3
    p = {r.payment_type_id: r for r in dims.dim_payment_types(spark).collect()}
    assert sorted(p) == [0, 1, 2, 3, 4, 5, 6] and p[0].is_cashless


def test_fact_derivations(spark):  # E7, E20
    y = raw(spark, "yellow", {"fare_amount": 0.0, "trip_distance": 1.0, "payment_type": None,
                              "tpep_pickup_datetime": dt.datetime(2024, 1, 7, 23, 59, 59),
                              "tpep_dropoff_datetime": dt.datetime(2024, 1, 8, 0, 0, 1)})
    zones = dims.dim_zones(spark.createDataFrame([(1, "Manhattan", "A", "Yellow Zone")],
                                                 "location_id int, borough string, zone_name string, service_zone string"))
    f = build_fact(_unified(spark, yellow=y), zones, dims.dim_vehicle_class(spark)).first()
    assert (f.fare_per_mile, f.tip_pct, f.payment_type_id) == (0.0, None, 0)
    assert (f.pickup_dow, f.pickup_hour, f.trip_duration_minutes) == (7, 23, 1)
    assert (f.pickup_zone_name, f.dropoff_zone_name, f.vehicle_display_name) == ("A", None, "Yellow Taxi")


def test_fixture_counts_and_plan(spark):
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    per_class = dict(m[M.UNIFIED].groupBy("vehicle_class").count().collect())
    assert per_class == {"yellow": 4922, "green": 1269, "hvfhv": 932}
    fact = m[M.FACT]
    assert fact.count() == 7123
    assert plan_nodes(fact, "BroadcastHashJoin") == 3
    assert plan_nodes(fact, "SortMergeJoin") == 0
    assert plan_nodes(fact, "Exchange") == 1           # the dedup shuffle only


def test_filled_days_keep_every_trip_day_and_fill_gaps(spark):
    from tripflow.operators.dims import calendar_counts, filled_days
    d = dt.date
    days = spark.createDataFrame([(d(2023, 11, 28), "yellow", 2), (d(2023, 12, 1), "green", 1), (d(2023, 12, 3), "yellow", 5)],
                                 "pickup_date date, vehicle_class string, trips long")
    got = {(r.date_day, r.vehicle_class): r.trips for r in filled_days(days).collect()}
    every = [d(2023, 11, 28) + dt.timedelta(k) for k in range(6)]
    assert set(got) == {(x, c) for x in every for c in ("yellow", "green")}
    assert {k: v for k, v in got.items() if v} == {(d(2023, 11, 28), "yellow"): 2, (d(2023, 12, 1), "green"): 1, (d(2023, 12, 3), "yellow"): 5}
    # outside the calendar dimension, too, days have their attributes
    row = calendar_counts(days).where("date_day = date '2023-11-29'").first()
    assert (row.year, row.day_name, row.trips, row.week_start) == (2023, "Wednesday", 0, d(2023, 11, 27))
    assert filled_days(days.limit(0)).count() == 0
