"""Scale behaviour: hot keys, broadcast bounds."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from conftest import plan_nodes, plan_text
from tripflow.operators.joins import is_small, sized_broadcast
from tripflow.operators.unify import day_sizes, first_by_day, keep_first
from tripflow.sources import schemas as S


def _exchange_records(df) -> list[int]:
    """Shuffle records written by each exchange of an executed (adaptive) plan."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
            return
        if "QueryStage" in node.getClass().getSimpleName():   # shuffle, broadcast, result stages
            walk(node.plan())
            return
        if name == "Exchange":
            m = node.metrics()
            if m.contains("shuffleRecordsWritten"):
                out.append(m.apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_hot_key_dedup_ships_one_row_per_task(spark):
    """A third of all rows share one key: the partial limit collapses it before the shuffle."""
    t = dt.datetime(2024, 1, 1, 8, 0)
    n, parts = 30_000, 8
    ids = spark.range(0, n, numPartitions=parts)
    rows = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("trip_id"),
        F.lit("yellow").alias("vehicle_class"), F.lit(1).alias("vendor_id"),
        F.lit(t).cast("timestamp_ntz").alias("pickup_at"),
        F.lit(t + dt.timedelta(minutes=5)).cast("timestamp_ntz").alias("dropoff_at"),
        F.lit(t.date()).alias("pickup_date"), F.lit(1).alias("pickup_zone_id"), F.lit(2).alias("dropoff_zone_id"),
        F.lit(1).alias("passenger_count"), F.lit(1.0).alias("trip_distance_miles"), F.lit(5.0).alias("fare_amount"),
        (F.col("id") % 1000).cast("double").alias("tip_amount"), F.lit(9.0).alias("total_amount"),
        F.lit(1).alias("payment_type"), F.lit(1).alias("rate_code_id"),
        *[F.lit(0.0).alias(c) for c in ("extra", "mta_tax", "tolls_amount", "improvement_surcharge",
                                          "congestion_surcharge", "airport_fee")])
    assert rows.schema.names == S.CANONICAL_COLUMNS
    out = keep_first(rows)
    got = out.collect()
    hot = [r for r in got if r.trip_id == "hot"]
    assert len(got) == n - n // 3 + 1 and len(hot) == 1 and hot[0].tip_amount == 0.0
    written = _exchange_records(out)
    # every non-hot key once, the hot key at most once per map task
    assert written and max(written) <= (n - n // 3) + parts


def test_dimension_over_bound_is_not_broadcast(spark):
    dim = spark.range(25).select(F.col("id").cast("int").alias("k"))
    fact = spark.range(1000).select((F.col("id") % 25).cast("int").alias("k"))
    assert is_small(dim, 25 * 8) and not is_small(dim, 25 * 8 - 1)
    text = dim.select(F.repeat(F.lit("x"), 100).alias("t"))
    assert is_small(text, 25 * 108) and not is_small(text, 25 * 108 - 1)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_nodes(fact.join(sized_broadcast(dim, 1000), "k"), "BroadcastHashJoin") == 1
        assert plan_nodes(fact.join(sized_broadcast(dim, 100), "k"), "BroadcastHashJoin") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_date_filter_reaches_the_scan_below_the_dedup(spark, tmp_path):
    rows = spark.createDataFrame([tuple(None if f.name != "pickup_date" else dt.date(2024, 1, 1) for f in S.CANONICAL.fields)],
                                 S.CANONICAL)
    rows.write.partitionBy("pickup_date").parquet(str(tmp_path / "u"))
    stored = spark.read.schema(S.CANONICAL).parquet(str(tmp_path / "u")).select(*S.CANONICAL_COLUMNS)
    plan = plan_text(keep_first(stored).where(F.col("pickup_date") > F.lit("2024-02-01").cast("date")))
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_date", plan)
    # also with the newest date of another table, which is known only at run time
    newest = stored.select(F.max("pickup_date")).scalar()
    lazy = plan_text(keep_first(stored).where(F.col("pickup_date") > F.date_sub(newest, 1)))
    # above the window only the rank is filtered (the plan's tree names the window before any detail)
    conditions = re.findall(r"^Condition : (.*)$", lazy, flags=re.M)
    assert len(conditions) == 1 and "pickup_date" not in conditions[0]
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_date#\d+ >", lazy)


def test_row_checks_neither_explode_nor_shuffle_rows(spark):
    from tripflow.plans import checks as C
    t = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    parent = spark.range(50).select(F.col("id").alias("p"))
    checks = [C.Check("a", "not_null", "t", ("k",)), C.Check("b", "not_null", "t", ("v",)),
              C.Check("c", "relationships", "t", ("k",), to="p", field="p")]
    df = C.check_failures({"t": t, "p": parent}, checks)
    assert {r.check_id: r.failures for r in df.collect()} == {"a": 0, "b": 0, "c": 50}
    plan = plan_text(C.check_failures({"t": t, "p": parent}, checks[:2]))
    assert "hashpartitioning" not in plan and plan.count("Exchange SinglePartition") <= 1
    assert plan.index("Generate") < plan.index("HashAggregate")      # above it: only the one row of counts


def test_hot_value_in_checks_collapses_before_shuffle(spark):
    """A value holding a third of all rows: the fused check job shuffles per-task partials only."""
    from tripflow.plans import checks as C
    n, parts = 30_000, 8
    t = spark.range(0, n, numPartitions=parts).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("x")).alias("v"))
    checks = [C.Check("uq", "unique", "t", ("k",)), C.Check("nn", "not_null", "t", ("v",))]
    rep = {r.check_id: r.failures for r in C.run_checks(spark, {"t": t}, checks).collect()}
    assert rep == {"uq": 1, "nn": n // 3}
    job = C.check_failures({"t": t}, checks)
    job.collect()
    written = _exchange_records(job)
    # distinct keys once, the hot key at most once per task
    assert written and max(written) <= (n - n // 3) + 2 * parts


def test_dedup_by_day_splits_large_days_and_collapses_a_hot_key_before_its_shuffle(spark, tmp_path):
    """Days dealt in parts give the rows of ``keep_first``, and a key delivered over and over is no hot task."""
    t = dt.datetime(2024, 1, 1)
    n = 20_000
    # a third is one key; the others come two or three times, as in the feeds a key has one time and one date
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
    ids = spark.range(0, n, numPartitions=4).withColumn("k", key)
    rows = ids.select(
        F.md5(F.col("k").cast("string")).alias("trip_id"), F.lit("yellow").alias("vehicle_class"), F.lit(1).alias("vendor_id"),
        F.timestamp_add("SECOND", F.col("k"), F.lit(t).cast("timestamp_ntz")).alias("pickup_at"),
        F.lit(t).cast("timestamp_ntz").alias("dropoff_at"),
        F.date_add(F.lit(t.date()), F.pmod("k", F.lit(3)).cast("int")).alias("pickup_date"),
        F.lit(1).alias("pickup_zone_id"), F.lit(2).alias("dropoff_zone_id"),
        F.lit(1).alias("passenger_count"), F.lit(1.0).alias("trip_distance_miles"), F.lit(5.0).alias("fare_amount"),
        (F.col("id") % 1000).cast("double").alias("tip_amount"), F.lit(9.0).alias("total_amount"),
        F.lit(1).alias("payment_type"), F.lit(1).alias("rate_code_id"),
        *[F.lit(0.0).alias(c) for c in ("extra", "mta_tax", "tolls_amount", "improvement_surcharge",
                                          "congestion_surcharge", "airport_fee")])
    rows.write.parquet(str(tmp_path / "trips"))
    rows = spark.read.schema(S.CANONICAL).parquet(str(tmp_path / "trips")).select(*S.CANONICAL_COLUMNS)
    days = day_sizes(rows, part_rows=1000)
    assert sum(d.rows for d in days) == n and [len(d.crowded) for d in sorted(days)] == [0, 0, 1]
    out = first_by_day(rows, days, part_rows=1000)
    got, want = out.collect(), keep_first(rows).collect()
    assert sorted(got) == sorted(want) and out.columns == rows.columns
    # no exchange carries the hot key's copies: what went before the deal is at most a row of it per task
    assert max(_exchange_records(out)) < n * 3 // 4
    # a large day lies in parts
    assert re.search(r"hashpartitioning\(pickup_date#\d+, _part#", plan_text(out))


def test_dedup_by_day_is_one_shuffle_of_rows(spark, tmp_path):
    spark.createDataFrame([], S.CANONICAL).write.parquet(str(tmp_path / "trips"))
    rows = spark.read.schema(S.CANONICAL).parquet(str(tmp_path / "trips")).select(*S.CANONICAL_COLUMNS)
    out = first_by_day(rows, day_sizes(rows))
    assert plan_nodes(out, "Exchange") == 1 and out.collect() == []
