"""Loading by what arrived (ledger), and malformed input."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from conftest import plan_nodes, plan_text, raw
from tripflow.operators import dims, rejects, staging, unify
from tripflow.operators.fact import build_fact
from tripflow.operators.ledger import IngestLedger, arrived_files
from tripflow.sources import malformed
from tripflow.sources.readers import read_feed
from tripflow.sources.schemas import FACT_COLUMNS, RAW_SCHEMAS
from tripflow.streaming import delivery

FEEDS = ("yellow", "green", "hvfhv")


class Died(Exception):
    pass


def _dims(spark):
    zones = dims.dim_zones(spark.createDataFrame([(k, "Queens", f"Z{k}", "Boro Zone") for k in range(1, 8)],
                                                 "location_id int, borough string, zone_name string, service_zone string"))
    return zones, dims.dim_vehicle_class(spark)


def _drop(spark, folder, feed, name, *trips):
    """One Parquet file of a feed."""
    tmp = f"{folder}/_tmp/{feed}-{name}"
    raw(spark, feed, *trips).coalesce(1).write.parquet(tmp)
    os.makedirs(f"{folder}/{feed}", exist_ok=True)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    os.rename(f"{tmp}/{part}", f"{folder}/{feed}/{name}.parquet")


def _at(day, **more):
    t = dt.datetime.fromisoformat(day + " 08:00:00")
    return dict(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + dt.timedelta(minutes=9), **more)


def _first(spark, folder):
    for feed in FEEDS:
        _drop(spark, folder, feed, "first", {})
    _drop(spark, folder, "yellow", "january", _at("2024-01-10"), _at("2024-01-11", fare_amount=-1.0), _at("2024-01-12"))


def _second(spark, folder):
    _drop(spark, folder, "yellow", "late", _at("2024-01-02"), _at("2024-01-10", tip_amount=0.5))  # late, and a copy
    _drop(spark, folder, "yellow", "again", _at("2024-01-10"), _at("2024-01-12"))                 # delivered twice
    _drop(spark, folder, "yellow", "future", _at("2099-05-05"))
    _drop(spark, folder, "green", "late", dict(trip_distance=3.0))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _equals_full_build(spark, folder, out, zones, classes):
    raws = {f: read_feed(spark, f"{folder}/{f}/*.parquet", RAW_SCHEMAS[f]) for f in FEEDS}
    unified = unify.unify_trips(staging.stage_yellow(raws["yellow"]), staging.stage_green(raws["green"]),
                                staging.stage_hvfhv(raws["hvfhv"]))
    stored = spark.read.parquet(f"{out}/int_trips_unified").select(*unified.columns)
    assert _rows(stored) == _rows(unified)
    fact = build_fact(unified, zones, classes)
    assert _rows(spark.read.parquet(f"{out}/fct_trips").select(*FACT_COLUMNS)) == _rows(fact)
    assert _rows(spark.read.parquet(f"{out}/int_trip_anomalies").drop("batch_id")) == _rows(rejects.trip_anomalies(raws))
    assert _rows(delivery.reject_audit_from_counts(spark, out)) == _rows(rejects.reject_audit(raws))


def _load(spark, folder, out, zones, classes, **more):
    return delivery.deliver_arrived(spark, {f: f"{folder}/{f}" for f in FEEDS}, out, zones, classes, **more)


def test_late_repeated_and_future_files_load_once(spark, tmp_path):
    zones, classes = _dims(spark)
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _first(spark, folder)
    done = _load(spark, folder, out, zones, classes, max_files=3)
    assert [x["load"] for x in done] == [0, 1] and [x["files"] for x in done] == [3, 1]
    assert sum(x["rows"] for x in done) == 6
    _equals_full_build(spark, folder, out, zones, classes)
    assert _load(spark, folder, out, zones, classes) == []           # nothing arrived
    _second(spark, folder)
    done = _load(spark, folder, out, zones, classes)
    assert [(x["load"], x["files"], x["rows"], x["resumed"]) for x in done] == [(2, 4, 6, False)]
    _equals_full_build(spark, folder, out, zones, classes)
    ledger = IngestLedger(spark, f"{out}/ingest_ledger")
    entries = ledger.entries().collect()
    assert len(entries) == 8 and {e.status for e in entries} == {"loaded"}
    assert sorted(e.load for e in entries) == [0, 0, 0, 1, 2, 2, 2, 2]
    assert all(e.rows is not None and e.length > 0 and e.modified for e in entries)


@pytest.mark.parametrize("step", ["unified", "ledger", "close"])
def test_a_load_that_dies_is_repeated_with_the_same_files(spark, tmp_path, monkeypatch, step):
    zones, classes = _dims(spark)
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _first(spark, folder)
    _load(spark, folder, out, zones, classes)
    _second(spark, folder)

    def die(*a, **b):
        raise Died
    with monkeypatch.context() as m:
        if step == "unified":            # after the note, before the first table
            real = delivery.PartitionedTable.replace
            m.setattr(delivery.PartitionedTable, "replace",
                      lambda self, df, info: die() if self.path.endswith("int_trips_unified") else real(self, df, info))
        elif step == "ledger":           # all tables done, the ledger not
            m.setattr(IngestLedger, "finish", die)
        else:                            # the ledger done, the note still there
            from tripflow.files import Store
            real = Store.delete
            m.setattr(Store, "delete", lambda self, path: die() if path.endswith("_open.json") else real(self, path))
        with pytest.raises(Died):
            _load(spark, folder, out, zones, classes)
    _drop(spark, folder, "hvfhv", "more", dict(trip_miles=9.0))      # arrives while the load is open
    done = _load(spark, folder, out, zones, classes)
    assert [(x["load"], x["files"], x["resumed"]) for x in done] == [(1, 4, True), (2, 1, False)]
    _equals_full_build(spark, folder, out, zones, classes)
    entries = IngestLedger(spark, f"{out}/ingest_ledger").entries()
    assert entries.count() == entries.select("path").distinct().count() == 9


def test_a_file_written_anew_is_a_new_arrival(spark, tmp_path):
    folder = str(tmp_path / "raw")
    _drop(spark, folder, "yellow", "a", {})
    ledger = IngestLedger(spark, str(tmp_path / "ledger"))
    files = arrived_files(spark, {"yellow": f"{folder}/yellow"})
    assert files.columns == ["feed", "path", "length", "modified"] and ledger.pending(files).count() == 1
    f = files.first().asDict()
    ledger.finish(ledger.begin([f]), {f["path"]: 1}, [])
    assert ledger.pending(files).count() == 0 and ledger.open_load() is None
    os.utime(f"{folder}/yellow/a.parquet", (1_700_000_000, 1_700_000_000))
    assert ledger.pending(arrived_files(spark, {"yellow": f"{folder}/yellow"})).count() == 1


def test_truncated_and_empty_files(spark, tmp_path):
    zones, classes = _dims(spark)
    folder, out = str(tmp_path / "raw with space"), str(tmp_path / "out")
    _first(spark, folder)
    _drop(spark, folder, "yellow", "empty")
    data = open(f"{folder}/yellow/january.parquet", "rb").read()
    with open(f"{folder}/yellow/cut.parquet", "wb") as f:
        f.write(data[:len(data) // 2])
    with open(f"{folder}/green/text.parquet", "w") as f:
        f.write("no Parquet at all")
    done = _load(spark, folder, out, zones, classes)
    assert len(done) == 1 and sorted(os.path.basename(f) for f in done[0]["unreadable"]) == ["cut.parquet", "text.parquet"]
    status = {os.path.basename(e.path): (e.status, e.rows) for e in
              IngestLedger(spark, f"{out}/ingest_ledger").entries().collect()}
    assert status["cut.parquet"] == ("unreadable", None) and status["empty.parquet"] == ("loaded", 0)
    assert _load(spark, folder, out, zones, classes) == []
    os.remove(f"{folder}/yellow/cut.parquet")
    os.remove(f"{folder}/green/text.parquet")
    _equals_full_build(spark, folder, out, zones, classes)


def test_broken_zone_rows_are_reported(spark, tmp_path):
    path = str(tmp_path / "zones.csv")
    with open(path, "w") as f:
        f.write('LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\nnot a number,Queens,"Jamaica Bay",Boro Zone\n'
                '3,Bronx,"Allerton, North",Boro Zone\n4,Manhattan\n')
    assert [r.LocationID for r in malformed.sound_zones(spark, path).collect()] == [1, 3]
    report = malformed.zone_report(spark, path).collect()
    assert [(r.feed, r.record, r.reason) for r in report] == [
        ("zone", 'not a number,Queens,"Jamaica Bay",Boro Zone', "unparsed row"), ("zone", "4,Manhattan", "unparsed row")]
    assert all(r.file.endswith("zones.csv") for r in report)


def test_build_leaves_malformed_input_out_and_reports_it(spark, tmp_path):
    from tripflow.__main__ import main
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _first(spark, folder)
    with open(f"{folder}/hvfhv/cut.parquet", "wb") as f:
        f.write(open(f"{folder}/hvfhv/first.parquet", "rb").read()[:100])
    with open(tmp_path / "zones.csv", "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,Queens,Z1,Boro Zone\nx,y,z,w\n2,Queens,Z2,Boro Zone\n")
    args = ["build", *[x for f in FEEDS for x in (f"--{f}", f"{folder}/{f}")], "--zones", str(tmp_path / "zones.csv"),
            "--out", out, "--as-of", "2026-12-03 00:00:00", "--skip-malformed"]
    assert main(args) in (0, 1)
    report = spark.read.parquet(f"{out}/malformed_inputs").collect()
    assert sorted((r.feed, os.path.basename(r.file), r.reason) for r in report) == [
        ("hvfhv", "cut.parquet", "unreadable file"), ("zone", "zones.csv", "unparsed row")]
    assert spark.read.parquet(f"{out}/fct_trips").count() == 5
    assert spark.read.parquet(f"{out}/dim_zones").count() == 2


def test_a_run_of_many_loads_merges_the_tables_once(spark, tmp_path, monkeypatch):
    zones, classes = _dims(spark)
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _first(spark, folder)
    _second(spark, folder)
    written = []
    real = delivery.PartitionedTable.replace
    monkeypatch.setattr(delivery.PartitionedTable, "replace", lambda self, df, info: (written.append(os.path.basename(self.path)),
                                                                                     real(self, df, info)))
    assert [x["files"] for x in _load(spark, folder, out, zones, classes, max_files=2)] == [2, 2, 2, 2]
    assert written == ["int_trips_unified", "fct_trips"]
    _equals_full_build(spark, folder, out, zones, classes)
    assert os.listdir(f"{out}/_arrived") == []


def test_rows_of_recorded_loads_reach_the_tables_after_a_death(spark, tmp_path, monkeypatch):
    zones, classes = _dims(spark)
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _first(spark, folder)

    def die(*a):
        raise Died
    with monkeypatch.context() as m:
        real = IngestLedger.begin
        m.setattr(IngestLedger, "begin", lambda self, files: die() if self.loads() else real(self, files))
        with pytest.raises(Died):
            _load(spark, folder, out, zones, classes, max_files=3)      # one load is recorded, nothing is merged
    assert not os.path.exists(f"{out}/fct_trips")
    gone = os.listdir(f"{folder}/yellow")
    ledger = IngestLedger(spark, f"{out}/ingest_ledger")
    taken = {os.path.basename(e.path) for e in ledger.entries().collect() if e.feed == "yellow"}
    for name in set(gone) - taken:
        os.remove(f"{folder}/yellow/{name}")
    assert _load(spark, folder, out, zones, classes) == []              # nothing arrived, the rest is done
    _equals_full_build(spark, folder, out, zones, classes)


def test_a_merge_shuffles_the_rows_once_and_sorts_no_wide_rows(spark, tmp_path, monkeypatch):
    zones, classes = _dims(spark)
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _first(spark, folder)
    written = {}
    real = delivery.PartitionedTable.replace

    def replace(self, df, info):
        written[os.path.basename(self.path)] = (self.dealt, plan_nodes(df, "Exchange"), "REBALANCE" in plan_text(df),
                                                df.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        real(self, df, info)
    monkeypatch.setattr(delivery.PartitionedTable, "replace", replace)
    for arrive in (_first, _second):
        if arrive is _second:
            _second(spark, folder)
        _load(spark, folder, out, zones, classes)
        # dealt by the shuffle that meets the copies; the fact is written from that without another one
        assert written == {"int_trips_unified": (True, 1, False, "64"), "fct_trips": (True, 0, False, "64")}
        _equals_full_build(spark, folder, out, zones, classes)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
