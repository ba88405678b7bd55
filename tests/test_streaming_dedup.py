"""Streaming deduplication: once per key, bounded state, restart from the checkpoint."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from conftest import raw
from tripflow.streaming import dedup

T0 = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc).timestamp()
DAY = 86400


def _trip(k, **more):
    t = dt.datetime(2024, 1, 1 + k % 28, 8, k // 28 % 60)
    return dict(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + dt.timedelta(minutes=7), **more)


def _arrive(spark, folder, name, day, *trips):
    """A yellow file that arrives on a day."""
    tmp = f"{folder}/tmp-{name}"
    raw(spark, "yellow", *trips).coalesce(1).write.parquet(tmp)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    os.makedirs(f"{folder}/yellow", exist_ok=True)
    os.utime(f"{tmp}/{part}", (T0 + day * DAY, T0 + day * DAY))
    os.rename(f"{tmp}/{part}", f"{folder}/yellow/{name}.parquet")


def _run(spark, folder, out):
    q = dedup.start_dedup(spark, {"yellow": f"{folder}/yellow"}, out, horizon="2 days", max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    states = [s for p in q.recentProgress for s in p.stateOperators]
    return [(s.numRowsTotal, s.numRowsDroppedByWatermark) for s in states]


def _keys(spark, out):
    return sorted(r.trip_id for r in spark.read.parquet(f"{out}/trips").select("trip_id").collect())


def test_a_key_delivered_again_appears_once_and_state_is_evicted(spark, tmp_path):
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _arrive(spark, folder, "a", 0, *[_trip(k) for k in range(10)], _trip(3), _trip(90, fare_amount=-1.0))
    _arrive(spark, folder, "b", 1, *[_trip(k) for k in range(5, 15)])          # five of them again
    states = _run(spark, folder, out)
    assert len(_keys(spark, out)) == len(set(_keys(spark, out))) == 15
    # a restart reads on from the checkpoint; copies across the restart are dropped, too
    _arrive(spark, folder, "c", 2, *[_trip(k) for k in range(12, 20)])
    states = _run(spark, folder, out)
    assert len(_keys(spark, out)) == len(set(_keys(spark, out))) == 20
    assert max(n for n, _ in states) == 20
    # later days push the watermark past the first keys: the state shrinks, though more keys have passed
    for d in range(8, 14):
        _arrive(spark, folder, f"late{d}", d, _trip(100 + d))
    states = _run(spark, folder, out)
    assert len(_keys(spark, out)) == len(set(_keys(spark, out))) == 26
    assert states[-1][0] <= 6
    # trips of old dates are not late: arrival is the event
    _arrive(spark, folder, "old-trips", 14, _trip(27), _trip(26))
    states = _run(spark, folder, out)
    assert len(_keys(spark, out)) == 28 and all(dropped == 0 for _, dropped in states)
    assert _run(spark, folder, out) is not None and len(_keys(spark, out)) == 28


def test_the_table_equals_a_batch_build_on_keys(spark, tmp_path):
    from tripflow.operators.staging import stage_yellow
    from tripflow.operators.unify import canonical, keep_first
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    trips = [_trip(k, tip_amount=float(k % 3)) for k in range(40)]
    for d in range(4):
        _arrive(spark, folder, f"f{d}", d / 2, *trips[d * 8:d * 8 + 16])
    _run(spark, folder, out)
    want = keep_first(canonical(stage_yellow(raw(spark, "yellow", *trips)), "yellow"))
    got = spark.read.parquet(f"{out}/trips").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_files_follow_the_tasks_that_write_and_the_state_is_off_the_heap(spark, tmp_path):
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _arrive(spark, folder, "a", 0, *[_trip(k) for k in range(600)], *[_trip(k) for k in range(50)])
    name, provider = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
    before, own = spark.conf.get(name), spark.conf.get(provider)
    spark.conf.set(name, "40")
    try:
        q = dedup.start_dedup(spark, {"yellow": f"{folder}/yellow"}, out, write_tasks=3)
        q.awaitTermination(300)
    finally:
        spark.conf.set(name, before)
    assert q.exception() is None and len(_keys(spark, out)) == len(set(_keys(spark, out))) == 600
    states = [s for p in q.recentProgress for s in p.stateOperators]
    # the caller's number of state partitions holds, but not each of them writes a file of every date
    assert {s.numShufflePartitions for s in states} == {40}
    dates = [d for d in os.listdir(f"{out}/trips") if d.startswith("pickup_date=")]
    assert len(dates) == 28
    assert all(sum(f.endswith(".parquet") for f in os.listdir(f"{out}/trips/{d}")) <= 3 for d in dates)
    assert any(m.startswith("rocksdb") for s in states for m in s.customMetrics) and spark.conf.get(provider) == own


def _start(spark, folder, out, partitions, **more):
    """(state partitions, whether tasks combine them) of a run in a session with so many shuffle partitions."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions))
    try:
        q = dedup.start_dedup(spark, {"yellow": f"{folder}/yellow"}, out, **more)
        q.awaitTermination(300)
        assert spark.conf.get(name) == str(partitions)
    finally:
        spark.conf.set(name, before)
    assert q.exception() is None
    return {s.numShufflePartitions for p in q.recentProgress for s in p.stateOperators}, "Coalesce" in q._jsq.explainInternal(False)


def test_each_writing_task_has_one_part_of_the_state(spark, tmp_path):
    """So that it runs where that part is held: Spark places combined partitions by host, not by executor."""
    folder, cores = str(tmp_path / "raw"), spark.sparkContext.defaultParallelism
    _arrive(spark, folder, "a", 0, *[_trip(k) for k in range(60)])
    assert _start(spark, folder, str(tmp_path / "new"), cores + 30) == ({cores}, False)
    assert _start(spark, folder, str(tmp_path / "few"), 2) == ({2}, False)
    assert len(_keys(spark, str(tmp_path / "new"))) == len(_keys(spark, str(tmp_path / "few"))) == 60


def test_a_stream_that_began_with_more_parts_keeps_them(spark, tmp_path):
    folder, out, cores = str(tmp_path / "raw"), str(tmp_path / "out"), spark.sparkContext.defaultParallelism
    _arrive(spark, folder, "a", 0, *[_trip(k) for k in range(60)])
    assert _start(spark, folder, out, cores + 30, write_tasks=3) == ({cores + 30}, True)
    _arrive(spark, folder, "b", 1, *[_trip(k) for k in range(50, 70)])
    assert _start(spark, folder, out, cores) == ({cores + 30}, True)
    assert len(_keys(spark, out)) == len(set(_keys(spark, out))) == 70


def test_unknown_arrival(spark, tmp_path):
    with pytest.raises(ValueError):
        dedup.arrival_time("pickup")
