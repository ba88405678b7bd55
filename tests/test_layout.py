"""Clustered date partitions and bucketed merges: what the layout saves."""

from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq

from conftest import plan_text
from test_incremental import _dims, _trip
from tripflow.operators.bucketed import BucketedTable
from tripflow.operators.fact import build_fact
from tripflow.operators.incremental import PARTITION_COLUMN, merge_increment, upsert_fact_table
from tripflow.operators.partitioned import PartitionedTable
from tripflow.sources import schemas as S


def _zone_trips(spark, n, zones):
    t = dt.datetime(2024, 1, 5, 8)
    rows = [(f"k{i}", "yellow", 1, t, t + dt.timedelta(minutes=5), t.date(), (i * 7919) % zones, 1, 1, 1.0, 1.0 + i, 0.0,
             1.0, 1, 1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(n)]
    return spark.createDataFrame(rows, S.CANONICAL).repartition(6)


def _groups(path):
    """(zone minimum, zone maximum, rows) of each row group."""
    out = []
    for f in glob.glob(f"{path}/pickup_date=*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index("pickup_zone_id")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            out.append((s.min, s.max, meta.row_group(g).num_rows))
    return out


def test_a_zone_filter_reads_a_fraction_of_the_row_groups(spark, tmp_path):
    zones, classes = _dims(spark)
    trips = _zone_trips(spark, 40000, 200)
    read = {}
    for name, cluster in (("plain", ()), ("clustered", ("pickup_zone_id",))):
        path = str(tmp_path / name)
        df = build_fact(trips, zones, classes)
        spark.conf.set("parquet.block.size", str(64 << 10))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            PartitionedTable(spark, path, PARTITION_COLUMN, cluster).create(df)
        finally:
            spark.conf.unset("parquet.block.size")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert spark.read.schema(S.FACT).parquet(path).where("pickup_zone_id = 17").count() == 200
        groups = _groups(path)
        read[name] = sum(n for low, high, n in groups if low <= 17 <= high) / sum(n for *_, n in groups)
    assert read["plain"] > 0.9 and read["clustered"] < 0.25


def test_loads_keep_the_layout_and_the_rows(spark, tmp_path):
    zones, classes = _dims(spark)
    path = str(tmp_path / "fct")
    for rows in ([_trip("a", 1, 1.0), _trip("b", 2, 1.0)], [_trip("b", 2, 5.0), _trip("c", 3, 1.0)]):
        upsert_fact_table(spark, path, spark.createDataFrame(rows, S.CANONICAL), zones, classes, cluster=("pickup_zone_id",))
    got = sorted((r.trip_id, r.fare_amount) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1.0), ("b", 5.0), ("c", 1.0)]


def test_bucketed_merge_does_not_move_the_target(spark, tmp_path):
    zones, classes = _dims(spark)
    fact = build_fact(_zone_trips(spark, 3000, 50), zones, classes)
    batch = build_fact(_zone_trips(spark, 3600, 7).where("cast(substr(trip_id, 2) as int) >= 2500"), zones, classes)
    want = sorted(map(tuple, merge_increment(fact, batch).collect()))
    table = BucketedTable(spark, "fct_bucketed", str(tmp_path / "buckets"), buckets=8)
    table.create(fact)
    probe = BucketedTable(spark, "probe_batch_table", str(tmp_path / "probe"), buckets=8)
    probe.create(batch)
    text = plan_text(table.merged(probe.read().hint("merge")), "simple")
    join = text[text.index("SortMergeJoin"):]
    assert "Exchange" not in join and "Bucketed: true" in join
    table.merge(batch)
    assert sorted(map(tuple, table.read().select(*S.FACT_COLUMNS).collect())) == want
    # the new version is in buckets, too: the next merge does not move it either
    table.merge(batch)
    assert sorted(map(tuple, table.read().select(*S.FACT_COLUMNS).collect())) == want
    text = plan_text(table.merged(probe.read().hint("merge")), "simple")
    assert "Exchange" not in text[text.index("SortMergeJoin"):]
    assert len(table.versions()) == 3
    table.drop_old()
    assert len(table.versions()) == 1 and table.read().count() == 3600
    for t in (table, probe):
        for name in t.versions():
            spark.sql(f"drop table {name}")
