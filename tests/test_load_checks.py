"""Checks counted by the job that writes, and kept up to date by loads."""

from __future__ import annotations

import os

import pytest

from conftest import plan_text
from test_incremental import _dims, _trip
from tripflow.operators import partitioned as P
from tripflow.operators.incremental import PARTITION_COLUMN, upsert_fact_table
from tripflow.operators.partitioned import PartitionedTable
from tripflow.plans import checks as C
from tripflow.plans import load_checks as L
from tripflow.plans import suite as M
from tripflow.sources import schemas as S

AS_OF = "2026-12-03 00:00:00"


def _bad(key, day, **fields):
    names = [f.name for f in S.CANONICAL.fields]
    row = dict(zip(names, _trip(key, day, 10.0), strict=True)) | fields
    return tuple(row[n] for n in names)


@pytest.fixture()
def world(spark, tmp_path):
    zones, classes = _dims(spark)
    tables = {M.DIM_ZONES: zones, M.DIM_CLASS: classes,
              M.DIM_DATE: spark.sql("select explode(sequence(date '2024-01-01', date '2024-01-20')) as date_day"),
              M.DIM_PAYMENT: spark.createDataFrame([(0,), (1,)], "payment_type_id int")}
    path = str(tmp_path / "fct")
    suite = [c for c in M.full_suite(AS_OF) if c.model == M.FACT]
    return spark, path, tables, suite


def _load(world, rows):
    spark, path, tables, suite = world
    checks = L.LoadChecks(spark, suite, tables)
    upsert_fact_table(spark, path, spark.createDataFrame(rows, S.CANONICAL), tables[M.DIM_ZONES], tables[M.DIM_CLASS], checks=checks)
    return checks


def _scan(world):
    """Every check by a scan of the table."""
    spark, path, tables, suite = world
    fact = {M.FACT: spark.read.schema(S.FACT).parquet(path), **tables}
    return {r.check_id: r.failures for r in C.run_checks(spark, fact, suite).collect()}


def _known(world, checks):
    return checks.known(PartitionedTable(world[0], world[1], PARTITION_COLUMN))


FIRST = [_trip("a", 1, 5.0), _trip("b", 2, 5.0), _bad("c", 2, pickup_zone_id=99), _bad("d", 3, total_amount=50.0),
         _bad("e", 3, dropoff_zone_id=None), _bad("f", 3, payment_type=9), _bad("d", 3, total_amount=51.0)]
SECOND = [_bad("d", 3, total_amount=10.0), _bad("g", 4, pickup_zone_id=98), _bad("h", 4, total_amount=None), _bad("h", 4, total_amount=1.0)]


def test_counts_of_loads_equal_a_scan(world):
    spark, path, tables, suite = world
    for rows in (FIRST, SECOND, [_trip("z", 5, 1.0)]):
        checks = _load(world, rows)
        state = PartitionedTable(spark, path, PARTITION_COLUMN).state()
        assert state is not None                        # kept by the load, not by a scan
        known, scan = _known(world, checks), _scan(world)
        assert set(scan) - set(known) == {"singular.no_future_trips"}
        assert {k: scan[k] for k in known} == known
        assert sum(rows for rows, _ in state["days"].values()) == spark.read.parquet(path).count()
    assert scan["unique_combination.fct_trips"] >= 1 and scan["singular.total_equals_components"] >= 1


def test_report_of_a_built_table_reads_only_days_behind_the_clock(world):
    spark, path, tables, suite = world
    checks = _load(world, FIRST)
    fact = {M.FACT: spark.read.schema(S.FACT).parquet(path), **tables}
    df = C.run_checks(spark, fact, suite, _known(world, checks))
    assert {r.check_id: r.failures for r in df.collect()} == _scan(world)
    text = plan_text(df)
    scans = [p for p in text.split("\n\n") if "Scan parquet" in p and "PartitionFilters" in p]
    assert len(scans) == 1 and "2026-12-03" in scans[0]


def test_keys_of_one_day_are_counted_with_one_partition(world):
    spark, path, _, _ = world
    _load(world, FIRST)
    table = spark.read.schema(S.FACT).parquet(path)
    df = L.key_counts(table, days=["2024-01-03"])
    assert [tuple(r) for r in df.collect()] == [("2024-01-03", 4, 1)]
    scan = next(p for p in plan_text(df).split("\n\n") if "Scan parquet" in p and "PartitionFilters" in p)
    assert "2024-01-03" in scan and "fare_amount" not in scan.split("ReadSchema")[1]
    assert {r.day: (r.rows, r.repeated) for r in L.key_counts(table).collect()} == {
        "2024-01-01": (1, 0), "2024-01-02": (2, 0), "2024-01-03": (4, 1)}


def test_a_changed_parent_or_foreign_load_is_counted_anew(world):
    spark, path, tables, suite = world
    _load(world, FIRST)
    more = {**tables, M.DIM_PAYMENT: spark.createDataFrame([(0,), (1,), (9,)], "payment_type_id int")}
    changed = (spark, path, more, suite)
    checks = L.LoadChecks(spark, suite, more)
    known = _known(changed, checks)
    assert known == {k: v for k, v in _scan(changed).items() if k in known}
    assert known["relationships.fct_trips.payment_type_id"] == 0
    # a load that counts nothing leaves no counts behind
    upsert_fact_table(spark, path, spark.createDataFrame(SECOND, S.CANONICAL), tables[M.DIM_ZONES], tables[M.DIM_CLASS])
    table = PartitionedTable(spark, path, PARTITION_COLUMN)
    assert table.state() is None
    known = _known(changed, checks)
    assert known == {k: v for k, v in _scan(changed).items() if k in known} and table.state() is not None


def test_an_observation_that_counted_twice_is_not_used(world, monkeypatch):
    spark, path, tables, suite = world

    class Twice(L.Observation):
        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}
    monkeypatch.setattr(L, "Observation", Twice)
    _load(world, FIRST)
    assert PartitionedTable(spark, path, PARTITION_COLUMN).state() is None


def test_a_load_that_dies_keeps_counts_and_rows_together(world, monkeypatch):
    spark, path, tables, suite = world
    _load(world, FIRST)
    real = PartitionedTable._finish

    def die(self, load, state):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(PartitionedTable, "_finish", die)
    with pytest.raises(RuntimeError):
        _load(world, SECOND)                            # after the manifest
    monkeypatch.setattr(PartitionedTable, "_finish", real)
    PartitionedTable(spark, path, PARTITION_COLUMN).recover()
    checks = L.LoadChecks(spark, suite, tables)
    state = PartitionedTable(spark, path, PARTITION_COLUMN).state()
    assert state is not None and "2024-01-04" in state["days"]
    known = _known(world, checks)
    assert known == {k: v for k, v in _scan(world).items() if k in known}


def test_empty_build(world):
    spark, path, tables, suite = world
    checks = _load(world, [])
    assert set(_known(world, checks).values()) == {0}
    assert os.path.exists(os.path.join(path, "_SUCCESS"))


def test_a_build_deals_rows_by_date_before_the_dimensions_are_joined(spark, tmp_path, monkeypatch):
    from conftest import plan_text
    from tripflow.operators import dims
    from tripflow.operators.incremental import upsert_fact_table
    from tripflow.operators.partitioned import PartitionedTable
    from tripflow.sources.schemas import CANONICAL
    spark.createDataFrame([], CANONICAL).write.parquet(str(tmp_path / "trips"))
    zones = spark.createDataFrame([(1, "Queens", "A")], "location_id int, borough string, zone_name string")
    seen = []
    monkeypatch.setattr(PartitionedTable, "create", lambda self, df, *a: seen.append((self.dealt, plan_text(df, "simple"))))
    trips = spark.read.schema(CANONICAL).parquet(str(tmp_path / "trips"))
    upsert_fact_table(spark, str(tmp_path / "fct"), trips, zones, dims.dim_vehicle_class(spark))
    dealt, plan = seen[0]
    assert dealt and plan.index("BroadcastHashJoin") < plan.index("REBALANCE_PARTITIONS_BY_COL")


def _dealt(spark, path, rows):
    """Trips as a table in folders of dates, read by a session that writes without a sort."""
    own = P.writing_session(spark)
    P.PartitionedTable(own, path, PARTITION_COLUMN, dealt=True).create(own.createDataFrame(rows, S.CANONICAL).hint("rebalance", PARTITION_COLUMN))
    return own, own.read.schema(S.CANONICAL).parquet(path).select(*S.CANONICAL_COLUMNS)


def test_loads_of_dealt_trips_count_as_others_do(world, tmp_path):
    spark, path, tables, suite = world
    for i, rows in enumerate((FIRST, SECOND, [_trip("z", 5, 1.0)])):     # new, held and new, new days alone
        own, trips = _dealt(spark, str(tmp_path / f"trips{i}"), rows)
        checks = L.LoadChecks(own, suite, tables)
        upsert_fact_table(own, path, trips, tables[M.DIM_ZONES], tables[M.DIM_CLASS], lookback_days=0 if i == 2 else 1,
                          checks=checks, dealt=True)
        state = PartitionedTable(spark, path, PARTITION_COLUMN).state()
        assert state is not None
        known, scan = _known(world, checks), _scan(world)
        assert {k: scan[k] for k in known} == known
    assert sorted(state["days"]) == [f"2024-01-0{d}" for d in range(1, 6)] and scan["unique_combination.fct_trips"] >= 1


def test_the_loads_of_the_query_shuffle_no_new_day(spark, monkeypatch):
    from conftest import SF_SMALL, plan_nodes
    from tripflow.plans import queries as Q
    seen = []
    for name in ("create", "replace"):
        real = getattr(PartitionedTable, name)
        monkeypatch.setattr(PartitionedTable, name, lambda self, df, *a, _real=real, **b: (
            seen.append((self.dealt, plan_nodes(df, "Exchange"), plan_text(df))), _real(self, df, *a, **b)))
    checks, table = Q._loaded_with_checks(spark, SF_SMALL)
    (d0, unified, _), (d1, build, _), (d2, _, load) = seen
    assert d0 and d1 and d2
    assert unified == 1 and build == 0          # deduplicated where it is written, then only read
    assert load.count("REBALANCE") >= 1 and "Union" in load
    assert table.state() is not None


def test_days_are_counted_by_hashes_and_exactly_where_these_agree(world, monkeypatch):
    spark, path, tables, suite = world
    checks = _load(world, FIRST)
    want = {"2024-01-01": [1, 0], "2024-01-02": [2, 0], "2024-01-03": [4, 1]}
    counted = []
    real = L.key_counts
    monkeypatch.setattr(L, "key_counts", lambda t, keys, days=None: (counted.append((list(keys), days)), real(t, keys, days))[1])
    assert checks._days(path) == want
    assert counted == [(["hash"], None), (S.TRIP_KEY, ["2024-01-03"])]
    # hashes that agree for different keys change no count
    monkeypatch.setattr(L.F, "xxhash64", lambda *c: L.F.lit(7))
    assert checks._days(path) == want
    assert counted[-1][0] == S.TRIP_KEY and sorted(counted[-1][1]) == ["2024-01-02", "2024-01-03"]
