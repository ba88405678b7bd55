from __future__ import annotations

from collections import Counter

from tripflow.llm import sharding
from .helpers import awkward, empty


def check(docs, limit):
    rows = sharding.assign_shards(docs, limit).collect()
    assert len(rows) == docs.count()
    held = Counter()
    for r in rows:
        held[r.shard] += r.n_bytes
    for r in rows:
        assert held[r.shard] == r.shard_bytes
        assert (r.shard_bytes <= limit) == r.fits
        assert r.fits or r.n_bytes > limit
    return rows


def test_every_shard_fits_and_only_oversized_buckets_split(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 700)) for i in range(3000)], "doc_id long, text string")
    rows = check(docs, 20000)
    size = Counter()
    for r in rows:
        for n in range(len(r.shard) + 1):
            size[r.shard[:n]] += r.n_bytes
    names = {r.shard for r in rows}
    for s in names:
        assert not any(o != s and o.startswith(s) for o in names)      # no shard lies in another
        assert s == "" or size[s[:-1]] > 20000                          # its parent had to split
    assert {r.shard for r in sharding.assign_shards(docs, 10 ** 9).collect()} == {""}


def test_rows_that_repeat_are_split(spark):
    docs = spark.createDataFrame([(7, "y" * 100)] * 400 + [(i, "z" * 50) for i in range(100)], "doc_id long, text string")
    check(docs.repartition(4), 1000)


def test_awkward_rows(spark):
    check(awkward(spark), 100)
    check(awkward(spark), 100_000)
    assert sharding.assign_shards(empty(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(300)], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "s"), 4000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 300
    assert all(r["count"] * 100 <= 4000 for r in back.groupBy("shard").count().collect())
