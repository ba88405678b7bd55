"""Streaming delivery equals the batch build (file source, foreachBatch, replay-safe sink)."""

from __future__ import annotations

from conftest import SF_SMALL
from tripflow.operators import rejects
from tripflow.plans import suite as M
from tripflow.plans.models import build_models
from tripflow.sources.fixtures import materialize_raw_feeds, raw_feeds
from tripflow.streaming.delivery import reject_audit_from_counts, start_delivery


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_matches_batch(spark, tmp_path):
    paths = materialize_raw_feeds(spark, SF_SMALL)
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    out = str(tmp_path / "out")
    q = start_delivery(spark, {k: paths[k] for k in ("yellow", "green", "hvfhv")}, out,
                       m[M.DIM_ZONES], m[M.DIM_CLASS], available_now=True, max_files_per_trigger=1,
                       checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(600)
    assert q.exception() is None
    assert len(q.recentProgress) >= 2                      # several micro-batches
    unified = spark.read.parquet(f"{out}/int_trips_unified").select(*m[M.UNIFIED].columns)
    assert _rows(unified) == _rows(m[M.UNIFIED])
    fact = spark.read.parquet(f"{out}/fct_trips").select(*m[M.FACT].columns)
    assert fact.count() == 7123
    assert _rows(fact.fillna("")) == _rows(m[M.FACT].fillna(""))
    anomalies = spark.read.parquet(f"{out}/int_trip_anomalies").drop("batch_id")
    assert _rows(anomalies) == _rows(m[M.ANOMALIES])
    feeds = {k: v for k, v in raw_feeds(spark, SF_SMALL).items() if k != "zone"}
    assert _rows(reject_audit_from_counts(spark, out)) == _rows(rejects.reject_audit(feeds))


def _deliver(spark, folder, out, zones, classes):
    q = start_delivery(spark, {k: str(folder / k) for k in ("yellow", "green", "hvfhv")}, out, zones, classes)
    q.awaitTermination(600)
    return q


def test_restart_after_a_crash_between_the_tables(spark, tmp_path, monkeypatch):
    """A micro-batch dies after the unified table and before the fact; a later query continues, also
    with months of other physical types, and everything equals a batch build over all files."""
    import shutil

    from pyspark.sql import functions as F

    from tripflow.operators.partitioned import PartitionedTable
    paths = materialize_raw_feeds(spark, SF_SMALL)
    folder, out = tmp_path / "raw", str(tmp_path / "out")
    for k in ("yellow", "green", "hvfhv"):
        shutil.copytree(paths[k].removeprefix("file:"), folder / k)
    m = build_models(spark, raw_feeds(spark, SF_SMALL))
    zones, classes = m[M.DIM_ZONES], m[M.DIM_CLASS]
    real = PartitionedTable.replace

    def replace(self, df, info):
        if self.path.endswith("fct_trips"):
            raise RuntimeError("executor lost")
        real(self, df, info)
    monkeypatch.setattr(PartitionedTable, "replace", replace)
    q = start_delivery(spark, {k: str(folder / k) for k in ("yellow", "green", "hvfhv")}, out, zones, classes)
    try:
        q.awaitTermination(600)
    except Exception:
        pass
    assert q.exception() is not None
    monkeypatch.setattr(PartitionedTable, "replace", real)
    # a second session's query: it replays the batch that died
    assert _deliver(spark.newSession(), folder, out, zones, classes).exception() is None
    # a new month with drifted types arrives
    late = spark.read.parquet(str(folder / "yellow")).limit(50).withColumn("VendorID", F.col("VendorID").cast("double"))
    late.coalesce(1).write.mode("append").parquet(str(folder / "yellow"))
    assert _deliver(spark, folder, out, zones, classes).exception() is None
    unified = spark.read.parquet(f"{out}/int_trips_unified").select(*m[M.UNIFIED].columns)
    fact = spark.read.parquet(f"{out}/fct_trips").select(*m[M.FACT].columns)
    assert unified.drop("vendor_id").exceptAll(m[M.UNIFIED].drop("vendor_id")).count() <= 50
    assert unified.count() >= m[M.UNIFIED].count() and fact.count() == unified.count()
    audit = {r.vehicle_class: r.total_rows for r in reject_audit_from_counts(spark, out).collect()}
    feeds = raw_feeds(spark, SF_SMALL)
    want = {k: feeds[k].count() + (50 if k == "yellow" else 0) for k in ("yellow", "green", "hvfhv")}
    assert audit == want
