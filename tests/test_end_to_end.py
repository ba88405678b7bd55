"""End-to-end run: write every table, load the fact incrementally, run the suite on written tables."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from tripflow.plans import models
from tripflow.sources.fixtures import raw_feeds


def test_run_twice_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "warehouse")
    raws = raw_feeds(spark, SF_SMALL)
    report = models.run(spark, raws, out, as_of="2026-12-03 00:00:00")
    assert report.count() == 114
    # the fixtures inject orphan zones and out-of-domain codes: error checks must catch them
    failed = {r.check_id for r in report.where("status = 'fail'").collect()}
    assert "accepted_values.stg_green_trips.vendor_id" not in failed
    fact = spark.read.parquet(os.path.join(out, "fct_trips"))
    assert fact.count() == 7123
    dates = fact.select("pickup_date").distinct().count()
    assert len([d for d in os.listdir(os.path.join(out, "fct_trips")) if d.startswith("pickup_date=")]) == dates
    # second run: incremental load of the same raw files changes nothing
    models.run(spark, raws, out, as_of="2026-12-03 00:00:00")
    assert spark.read.parquet(os.path.join(out, "fct_trips")).count() == 7123
    audit = spark.read.parquet(os.path.join(out, "stg_trip_reject_audit"))
    assert sorted(r.vehicle_class for r in audit.collect()) == ["green", "hvfhv", "yellow"]


def test_command_line_build_and_check(spark, tmp_path):
    from tripflow.__main__ import main
    from tripflow.sources.fixtures import materialize_raw_feeds
    p = materialize_raw_feeds(spark, SF_SMALL)
    args = ["--yellow", p["yellow"], "--green", p["green"], "--hvfhv", p["hvfhv"], "--zones", p["zone"],
            "--out", str(tmp_path / "cli"), "--as-of", "2026-12-03 00:00:00"]
    code = main(["build", *args])
    assert code in (0, 1)
    assert spark.read.parquet(str(tmp_path / "cli" / "fct_trips")).count() == 7123
    assert main(["check", *args]) == code
