"""Data-quality checks (J1-J9) and the suite report."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL, plan_nodes, plan_text
from tripflow.plans import checks as C
from tripflow.plans import suite as M
from tripflow.plans.models import build_models
from tripflow.sources.fixtures import raw_feeds


def _report(spark, tables, checks):
    return {r.check_id: (r.failures, r.status) for r in C.run_checks(spark, tables, checks).collect()}


def test_column_checks_semantics(spark):  # E21
    t = spark.createDataFrame([(1, "a", 10), (1, "b", None), (2, "x", 11), (None, "x", 99), (3, None, 10)],
                              "id int, v string, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    checks = [
        C.Check("nn", "not_null", "t", ("v",)),
        C.Check("uq", "unique", "t", ("id",), severity=C.WARN),
        C.Check("av", "accepted_values", "t", ("v",), values=("a", "b")),
        C.Check("rel", "relationships", "t", ("fk",), to="p", field="pk"),
        C.Check("uc", "unique_combination", "t", ("v", "fk")),
    ]
    got = _report(spark, {"t": t, "p": parent}, checks)
    assert got["nn"] == (1, "fail")          # one NULL row
    assert got["uq"] == (1, "warn")          # value 1 duplicated; NULL ignored
    assert got["av"] == (1, "fail")          # one bad distinct value 'x'; NULL passes
    assert got["rel"] == (1, "fail")         # 99 orphan; NULL child passes
    assert got["uc"] == (0, "pass")


def test_within_percentage(spark):  # E22
    df = spark.createDataFrame([(1, 5.0, 0.0), (2, 5.0, None), (3, 111.0, 100.0), (4, 105.0, 100.0)],
                               "id int, a double, b double")
    rows = C.within_percentage_failures(df, "a", "b", 10).collect()
    assert [(r.id, round(r.deviation_pct, 6)) for r in rows] == [(3, 11.0)]


def test_future_trips_and_mismatch(spark):
    t = dt.datetime(2099, 1, 1, 0, 30)
    fact = spark.createDataFrame(
        [("k", "yellow", t, 10.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 30.0)],
        "trip_id string, vehicle_class string, pickup_at timestamp_ntz, fare_amount double, tip_amount double, "
        "tolls_amount double, congestion_surcharge double, airport_fee double, extra double, mta_tax double, "
        "improvement_surcharge double, total_amount double")
    f = C.future_trips(fact, "2099-01-01 00:00:00").first()
    assert f.hours_in_future == 0                        # same hour: no boundary crossed
    assert C.future_trips(fact, "2098-12-31 23:59:59").first().hours_in_future == 1
    m = C.total_mismatch(fact).first()
    assert (m.computed_total, m.discrepancy) == (11.0, 19.0)


def test_suite_shape():
    suite = M.full_suite()
    assert len(suite) == 114
    assert sum(c.severity == C.WARN for c in suite) == 11
    kinds = {}
    for c in suite:
        kinds[c.kind] = kinds.get(c.kind, 0) + 1
    assert kinds == {"not_null": 70, "accepted_values": 19, "relationships": 13, "unique": 8,
                     "unique_combination": 2, "singular": 2}
    assert len({c.check_id for c in suite}) == 114


def test_fixture_report(spark):
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    rep = C.run_checks(spark, m, M.full_suite("2026-12-03 00:00:00"))
    rows = {r.check_id: r for r in rep.collect()}
    assert len(rows) == 114
    # re-delivered yellow rows share a key: the warn-level unique check trips
    assert rows["unique.stg_yellow_trips.trip_id"].status == "warn"
    assert rows["unique_combination.int_trips_unified"].failures == 0
    assert rows["singular.no_future_trips"].failures == 0
    assert rows["singular.total_equals_components"].failures == 11
    status = C.overall_status(rep).first()
    assert status.passed + status.warned + status.failed == 114


def test_scans_per_table_are_bounded(spark):
    """Row checks of a table share one scan, domain checks another, each key check has its own."""
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    checks = [c for c in M.full_suite() if c.model == M.STG_YELLOW]
    keys = sum(c.kind in ("unique", "unique_combination") for c in checks)
    assert len(checks) > 10
    assert plan_nodes(C.run_checks(spark, m, checks), "Scan parquet") <= 2 + keys


def test_key_checks_of_the_report_do_not_shuffle_the_trips(spark):
    from tripflow.plans import queries as Q
    df = Q.registry()["check_unique_combination"](spark, SF_SMALL)
    # the stored trips lie in buckets of the key, and the fact's joins keep them
    plan = plan_text(df)
    assert plan.count("Bucketed: true") == 2 and "hashpartitioning(trip_id" not in plan
    assert {r.check_id: r.failures for r in df.collect()} == {f"unique_combination.{t}": 0 for t in (M.UNIFIED, M.FACT)}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tripflow_")]


def test_combinations_group_nulls_and_do_not_mix_columns(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None), (None, None), ("1:a", None), ("1", ":a")]
    df = spark.createDataFrame(rows, "x string, y string")
    check = C.Check("u", "unique_combination", "t", ("x", "y"))
    assert [r.failures for r in C.run_checks(spark, {"t": df}, [check]).collect()] == [1]   # only the two (NULL, NULL) rows


def test_fused_counts_equal_per_check_queries(spark):
    """The fused per-table job agrees with one plain query per check."""
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    checks = [c for c in M.full_suite("2026-12-03 00:00:00")
              if c.model in (M.STG_YELLOW, M.UNIFIED, M.FACT, M.DIM_ZONES)]
    fused = {r.check_id: r.failures for r in C.run_checks(spark, m, checks).collect()}
    for c in checks:
        rows = C.failing_rows(m, c)
        n = rows.agg({"_rows": "sum"}).first()[0] or 0 if c.kind == "relationships" else rows.count()
        assert fused[c.check_id] == n, c.check_id
