"""Incremental delete+insert (A8, B14, C5, C6, I13; trap T7)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow.operators import dims
from tripflow.operators.incremental import incremental_fact, merge_increment, upsert_fact_table
from tripflow.plans import suite as M
from tripflow.plans.models import build_models
from tripflow.sources import schemas as S
from tripflow.sources.fixtures import raw_feeds


def _trip(key, day, amount):
    t = dt.datetime(2024, 1, day, 8, 0)
    return (key, "yellow", 1, t, t + dt.timedelta(minutes=5), t.date(), 1, 1, 1, 1.0, amount, 0.0,
            amount, 1, 1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def _dims(spark):
    zones = dims.dim_zones(spark.createDataFrame([(1, "Manhattan", "A", "Yellow Zone")],
                                                 "location_id int, borough string, zone_name string, service_zone string"))
    return zones, dims.dim_vehicle_class(spark)


def test_faithful_window(spark, tmp_path):  # E18
    zones, classes = _dims(spark)
    from tripflow.operators.fact import build_fact
    target = build_fact(spark.createDataFrame([_trip("k1", 1, 10.0), _trip("k2", 2, 10.0)], S.CANONICAL),
                        zones, classes)
    batch = spark.createDataFrame([_trip("k0", 1, 5.0), _trip("k2", 2, 99.0), _trip("k3", 3, 7.0)], S.CANONICAL)
    out = {r.trip_id: r.fare_amount for r in incremental_fact(target, batch, zones, classes).collect()}
    # 01-01 row k0 is late and lost, k2 replaced, k3 added, k1 kept
    assert out == {"k1": 10.0, "k2": 99.0, "k3": 7.0}

    # the same run through the partitioned Parquet table
    path = str(tmp_path / "fct")
    first = spark.createDataFrame([_trip("k1", 1, 10.0), _trip("k2", 2, 10.0)], S.CANONICAL)
    assert upsert_fact_table(spark, path, first, zones, classes)["mode"] == "full"
    res = upsert_fact_table(spark, path, batch, zones, classes)
    assert res["dates"] == ["2024-01-02", "2024-01-03"]
    got = {r.trip_id: r.fare_amount for r in spark.read.parquet(path).collect()}
    assert got == {"k1": 10.0, "k2": 99.0, "k3": 7.0}
    assert sorted(d for d in os.listdir(path) if d.startswith("pickup_date=")) == [
        "pickup_date=2024-01-01", "pickup_date=2024-01-02", "pickup_date=2024-01-03"]
    # idempotent re-run
    upsert_fact_table(spark, path, batch, zones, classes)
    assert spark.read.parquet(path).count() == 3


def test_empty_target_loads_nothing(spark, tmp_path):  # E19
    zones, classes = _dims(spark)
    target = spark.createDataFrame([], S.FACT)
    batch = spark.createDataFrame([_trip("k3", 3, 7.0)], S.CANONICAL)
    assert incremental_fact(target, batch, zones, classes).count() == 0
    path = str(tmp_path / "empty_fct")
    target.write.partitionBy("pickup_date").parquet(path)
    assert upsert_fact_table(spark, path, batch, zones, classes)["batch_rows"] == 0


def test_lookback_widens_window(spark):
    zones, classes = _dims(spark)
    from tripflow.operators.fact import build_fact
    target = build_fact(spark.createDataFrame([_trip("k2", 2, 10.0)], S.CANONICAL), zones, classes)
    batch = spark.createDataFrame([_trip("k0", 1, 5.0)], S.CANONICAL)
    assert incremental_fact(target, batch, zones, classes, lookback_days=2).count() == 2


def test_merge_is_anti_join_plus_union(spark):
    zones, classes = _dims(spark)
    from tripflow.operators.fact import build_fact
    t = build_fact(spark.createDataFrame([_trip("a", 1, 1.0), _trip("b", 1, 1.0)], S.CANONICAL), zones, classes)
    b = build_fact(spark.createDataFrame([_trip("b", 1, 2.0)], S.CANONICAL), zones, classes)
    assert sorted((r.trip_id, r.fare_amount) for r in merge_increment(t, b).collect()) == [("a", 1.0), ("b", 2.0)]


def test_fixture_rereads(spark):
    """sf0.001 has no future trips: after a full load the faithful batch is the max date only."""
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    fact = m[M.FACT]
    max_date = fact.agg(F.max("pickup_date")).first()[0]
    merged = incremental_fact(fact, m[M.UNIFIED], m[M.DIM_ZONES], m[M.DIM_CLASS])
    assert merged.count() == fact.count()
    assert m[M.UNIFIED].where(F.col("pickup_date") > F.date_sub(F.lit(max_date), 1)).count() > 0


def test_incremental_by_cuts_equals_full_build(spark, tmp_path):
    """Loading the trips in date order, one cut at a time, gives the full build."""
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    unified, zones, classes = m[M.UNIFIED], m[M.DIM_ZONES], m[M.DIM_CLASS]
    path = str(tmp_path / "fct_by_cuts")
    for cut in ("2024-01-15", "2024-02-01", "2024-02-20", "2099-12-31"):
        seen = unified.where(F.col("pickup_date") <= F.lit(cut).cast("date"))
        upsert_fact_table(spark, path, seen, zones, classes, ignore_after="2026-12-03 00:00:00")
    got = spark.read.parquet(path).select(*m[M.FACT].columns).fillna("")
    want = m[M.FACT].fillna("")
    assert got.count() == want.count() == 7123
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _load(spark, days, amount=1.0):
    return spark.createDataFrame([_trip(f"k{d}", d, amount) for d in days], S.CANONICAL)


def _days(spark, path):
    return sorted((r.trip_id, r.fare_amount) for r in spark.read.parquet(path).collect())


class Died(Exception):
    pass


def _die_at(table, step):
    """Make the table's store die at its ``step``-th deletion or move."""
    calls = {"n": 0}
    for name in ("delete", "move", "write_text"):
        real = getattr(table.store, name)

        def call(*a, real=real):
            calls["n"] += 1
            if calls["n"] == step:
                raise Died
            return real(*a)
        setattr(table.store, name, call)


def test_a_load_that_dies_anywhere_is_completed_by_the_next(spark, tmp_path):
    from tripflow.operators.partitioned import PartitionedTable
    zones, classes = _dims(spark)
    died = 0
    for step in range(1, 30):
        path = str(tmp_path / f"t{step}")
        upsert_fact_table(spark, path, _load(spark, [1, 2]), zones, classes)
        full = PartitionedTable.__init__

        def init(self, *a, full=full, step=step):
            full(self, *a)
            _die_at(self, step)
        PartitionedTable.__init__ = init
        try:
            upsert_fact_table(spark, path, _load(spark, [2, 3, 4, 5], 9.0), zones, classes)
            finished = True
        except Died:
            died += 1
            finished = False
        finally:
            PartitionedTable.__init__ = full
        res = upsert_fact_table(spark, path, _load(spark, [1, 2, 3, 4, 5], 9.0), zones, classes)
        assert _days(spark, path) == [("k1", 1.0), ("k2", 9.0), ("k3", 9.0), ("k4", 9.0), ("k5", 9.0)], (step, res)
        assert not os.path.exists(os.path.join(path, "_load.json"))
        assert not os.listdir(os.path.join(path, "_loads"))
        if finished:
            break
    assert died >= 8


def test_remains_of_a_first_build_are_no_table(spark, tmp_path):
    zones, classes = _dims(spark)
    path = tmp_path / "fct"
    (path / "pickup_date=2023-01-01").mkdir(parents=True)
    _load(spark, [9]).write.parquet(str(path / "pickup_date=2023-01-01" / "x"))
    assert upsert_fact_table(spark, str(path), _load(spark, [1, 2]), zones, classes) == {"mode": "full"}
    assert [k for k, _ in _days(spark, str(path))] == ["k1", "k2"]


def test_newest_date_ignores_later_rows_and_empty_days(spark, tmp_path):
    from tripflow.operators.incremental import PARTITION_COLUMN, newest_loaded_date
    from tripflow.operators.partitioned import PartitionedTable
    zones, classes = _dims(spark)
    path = str(tmp_path / "fct")
    upsert_fact_table(spark, path, _load(spark, [1, 2, 5]), zones, classes)
    os.makedirs(os.path.join(path, "pickup_date=2024-01-09"))
    table = PartitionedTable(spark, path, PARTITION_COLUMN)
    target = spark.read.schema(S.FACT).parquet(path)
    assert newest_loaded_date(table, target) == "2024-01-05"
    assert newest_loaded_date(table, target, "2024-01-05 07:59:59") == "2024-01-02"
    assert newest_loaded_date(table, target, "2024-01-05 08:00:00") == "2024-01-05"
    assert newest_loaded_date(table, target, "2023-01-05 08:00:00") is None


def test_only_dates_of_the_batch_meet_its_keys(spark, tmp_path, monkeypatch):
    from tripflow.operators import incremental
    from tripflow.operators.fact import build_fact
    zones, classes = _dims(spark)
    for name, trips in (("target", [_trip("k1", 1, 1.0), _trip("k2", 2, 2.0)]), ("trips", [_trip("k2", 2, 9.0), _trip("k3", 3, 3.0)])):
        spark.createDataFrame(trips, S.CANONICAL).write.parquet(str(tmp_path / name))
    target, trips = (spark.read.schema(S.CANONICAL).parquet(str(tmp_path / n)) for n in ("target", "trips"))
    df = incremental_fact(build_fact(target, zones, classes), trips, zones, classes)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(lines) if "Join LeftAnti" in x)
    column = lines[at + 1].index(":-")
    end = next(i for i in range(at + 1, len(lines)) if lines[i][column:column + 2] == "+-")
    assert any("Filter" in x and "date_sub" in x for x in lines[at + 1:end])      # rows of older dates are not joined
    assert {r.trip_id: r.fare_amount for r in df.collect()} == {"k1": 1.0, "k2": 9.0, "k3": 3.0}

    met = []
    real = incremental.kept_rows
    monkeypatch.setattr(incremental, "kept_rows", lambda old, batch: (met.append(sorted(r.trip_id for r in batch.collect())),
                                                                      real(old, batch))[1])
    path = str(tmp_path / "fct")
    upsert_fact_table(spark, path, target, zones, classes)
    upsert_fact_table(spark, path, trips, zones, classes)
    assert met == [["k2"]]                                   # the table has no row of k3's day
    assert {r.trip_id: r.fare_amount for r in spark.read.parquet(path).collect()} == {"k1": 1.0, "k2": 9.0, "k3": 3.0}
