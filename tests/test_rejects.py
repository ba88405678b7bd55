"""Staging filter, rejection flags, audit and anomalies (B8-B11, I1-I6, trap T1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, empty, plan_nodes, plan_text, raw
from tripflow.operators import rejects, staging
from tripflow.sources.fixtures import raw_feeds


def _audit(spark, feed, df):
    return rejects.audit_feed(df, feed).first().asDict()


def test_null_fare_is_rejected_without_label(spark):  # E1
    y = raw(spark, "yellow", {"fare_amount": None})
    assert staging.stage_yellow(y).count() == 0
    assert rejects.trip_anomalies({"yellow": y}).count() == 0
    a = _audit(spark, "yellow", y)
    assert (a["rejected_rows"], a["failed_neg_fare"]) == (1, 0)
    assert rejects.unlabelled_rejects({"yellow": y}).first()["unlabelled_rows"] == 1


def test_hvfhv_null_base_fare(spark):  # E2
    h = raw(spark, "hvfhv", {"base_passenger_fare": None, "tolls": 1.0})
    assert staging.stage_hvfhv(h).count() == 0
    assert rejects.trip_anomalies({"hvfhv": h}).count() == 0
    assert _audit(spark, "hvfhv", h)["rejected_rows"] == 1


def test_equal_timestamps(spark):  # E3
    t = dt.datetime(2024, 1, 1, 10, 0)
    y = raw(spark, "yellow", {"tpep_pickup_datetime": t, "tpep_dropoff_datetime": t})
    assert rejects.trip_anomalies({"yellow": y}).first()["rejection_reason"] == "invalid_timestamps"


def test_first_reason_and_multi_count(spark):  # E4
    y = raw(spark, "yellow", {"tpep_dropoff_datetime": None, "PULocationID": None})
    rows = rejects.trip_anomalies({"yellow": y}).collect()
    assert [r.rejection_reason for r in rows] == ["invalid_timestamps"]
    a = _audit(spark, "yellow", y)
    assert (a["failed_timestamp"], a["failed_null_pickup_zone"]) == (1, 1)


def test_null_distance(spark):  # E5
    y = raw(spark, "yellow", {"trip_distance": None})
    assert rejects.trip_anomalies({"yellow": y}).first()["rejection_reason"] == "zero_distance"


def test_zero_distance_only(spark):  # E6
    y = raw(spark, "yellow", {"trip_distance": 0.0, "fare_amount": 0.0, "total_amount": 0.0})
    assert rejects.trip_anomalies({"yellow": y}).first()["rejection_reason"] == "zero_distance"
    a = _audit(spark, "yellow", y)
    assert (a["failed_neg_fare"], a["failed_neg_total"], a["failed_zero_distance"]) == (0, 0, 1)


def test_empty_feed_audit(spark):  # E24
    a = _audit(spark, "green", empty(spark, "green"))
    assert (a["total_rows"], a["valid_rows"], a["rejected_rows"], a["rejection_pct"]) == (0, 0, 0, None)


def test_staged_schemas(spark):
    assert len(staging.stage_yellow(raw(spark, "yellow", {})).columns) == 21
    assert len(staging.stage_green(raw(spark, "green", {})).columns) == 22
    assert len(staging.stage_hvfhv(raw(spark, "hvfhv", {})).columns) == 29
    z = staging.stage_hvfhv(raw(spark, "hvfhv", {})).first()
    assert z.total_amount == 20.0 + 0.0 + 0.5 + 1.5 + 2.75 + 0.0 + 3.0
    assert z.vendor_id is None and z.passenger_count is None


def test_fixture_audit_and_accounting(spark):
    """sf0.001 expected counts, and anomalies + unlabelled = rejected per class."""
    feeds = {k: v for k, v in raw_feeds(spark, SF_SMALL).items() if k != "zone"}
    audit = {r.vehicle_class: r for r in rejects.reject_audit(feeds).collect()}
    expected = {"yellow": (6116, 5014, 1102, 18.02, 713, 71, 87, 149, 0, 151),
                "green": (1500, 1269, 231, 15.4, 61, 106, 63, 41, 0, 33),
                "hvfhv": (1000, 932, 68, 6.8, 31, 10, 0, 19, 0, 0)}
    for cls, exp in expected.items():
        a = audit[cls]
        got = (a.total_rows, a.valid_rows, a.rejected_rows, a.rejection_pct, a.failed_timestamp,
               a.failed_neg_fare, a.failed_neg_total, a.failed_zero_distance,
               a.failed_null_pickup_zone, a.failed_null_dropoff_zone)
        assert got == exp, cls
    labelled = dict(rejects.trip_anomalies(feeds).groupBy("vehicle_class").count().collect())
    unlabelled = dict(rejects.unlabelled_rejects(feeds).collect())
    for cls, a in audit.items():
        assert labelled.get(cls, 0) + unlabelled[cls] == a.rejected_rows
        assert a.total_rows == a.valid_rows + a.rejected_rows


def test_staging_filter_reaches_parquet_scan(spark):
    y = raw_feeds(spark, SF_SMALL)["yellow"]
    plan = plan_text(staging.stage_yellow(y))
    assert "PushedFilters" in plan and "IsNotNull(PULocationID)" in plan
    assert "GreaterThanOrEqual(fare_amount,0.0)" in plan


def test_audit_is_one_scan_per_feed(spark):
    feeds = {k: v for k, v in raw_feeds(spark, SF_SMALL).items() if k != "zone"}
    plan = plan_text(rejects.reject_audit(feeds))
    assert plan_nodes(rejects.reject_audit(feeds), "Scan parquet") == 3
    # the audit never computes the surrogate key
    assert "md5" not in plan
    assert rejects.reject_audit(feeds).where(F.col("total_rows") > 0).count() == 3


def test_audit_sql_of_an_empty_feed(spark):
    """Both sides have a row of a class whose feed is empty."""
    import oracle_compare as O
    from tripflow.plans.oracle import oracle_sql
    from tripflow.sources.fixtures import feed_sql
    feeds = {k: v for k, v in raw_feeds(spark, SF_SMALL).items() if k != "zone"} | {"hvfhv": empty(spark, "hvfhv")}
    got = sorted(map(tuple, rejects.reject_audit(feeds).collect()))
    feed = feed_sql("hvfhv", "duckdb")
    sql = oracle_sql()["reject_audit"]
    assert feed in sql
    want = O.duck(SF_SMALL).execute(sql.replace(feed, f"select * from ({feed}) where false")).df()
    want = sorted(tuple(None if v != v else v for v in r) for r in want[rejects.reject_audit(feeds).columns].itertuples(index=False))
    assert [r[0] for r in got] == ["green", "hvfhv", "yellow"]
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in want]
