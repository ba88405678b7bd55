"""The model graph: raw feeds -> staging -> audit/anomalies -> unified -> dims -> fact.

``build_models`` wires the twelve models as lazy DataFrames (views: nothing
runs). ``run`` materialises them the way a production run should at scale:

1. the unified table is written once, partitioned by ``pickup_date`` (it feeds
   the fact, the checks and the relationships), so the dedup shuffle runs once
   per run and an incremental fact batch prunes to the dates it loads;
2. anomalies and the audit are written from the raw feeds (narrow scan and a
   global aggregate);
3. dimensions are written (all small);
4. the fact is built from the written unified table with broadcast dimension
   joins, and written partitioned by ``pickup_date`` (full build or
   delete+insert increment), its checks counted by the same job (``load_checks``);
5. the other checks run against the written tables.

Each written table cuts lineage: a lost executor recomputes from the last
written table, not from the raw files.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators import dims, rejects, staging, unify
from tripflow.operators.fact import build_fact
from tripflow.operators.incremental import PARTITION_COLUMN, upsert_fact_table
from tripflow.operators.partitioned import PartitionedTable
from tripflow.sources.schemas import CANONICAL, CANONICAL_COLUMNS, FACT, FACT_COLUMNS
from tripflow.plans import suite as M
from tripflow.plans.checks import run_checks
from tripflow.plans.load_checks import LoadChecks

AUDIT = "stg_trip_reject_audit"
# the fact's rows of a date lie in the order of the zone that queries filter by
CLUSTER = ("pickup_zone_id",)


class Models(Mapping):
    """The model graph as a lazy mapping: a model is built on first access.

    Building a model is plan construction only (no job runs), and a query
    that reads one table never constructs the others.
    """

    def __init__(self, spark: SparkSession, raws: dict[str, DataFrame],
                 overrides: dict[str, DataFrame] | None = None):
        self._spark, self._raws = spark, raws
        self._cache: dict[str, DataFrame] = dict(overrides or {})
        feeds = lambda: {k: raws[k] for k in ("yellow", "green", "hvfhv")}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            M.STG_YELLOW: lambda: staging.stage_yellow(raws["yellow"]),
            M.STG_GREEN: lambda: staging.stage_green(raws["green"]),
            M.STG_HVFHV: lambda: staging.stage_hvfhv(raws["hvfhv"]),
            M.STG_ZONES: lambda: staging.stage_zones(raws["zone"]),
            AUDIT: lambda: rejects.reject_audit(feeds()),
            M.ANOMALIES: lambda: rejects.trip_anomalies(feeds()),
            M.UNIFIED: lambda: unify.unify_trips(self[M.STG_YELLOW], self[M.STG_GREEN], self[M.STG_HVFHV]),
            M.DIM_ZONES: lambda: dims.dim_zones(self[M.STG_ZONES]),
            M.DIM_DATE: lambda: dims.dim_date(spark),
            M.DIM_CLASS: lambda: dims.dim_vehicle_class(spark),
            M.DIM_PAYMENT: lambda: dims.dim_payment_types(spark),
            M.FACT: lambda: build_fact(self[M.UNIFIED], self[M.DIM_ZONES], self[M.DIM_CLASS]),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._builders[name]()
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build_models(spark: SparkSession, raws: dict[str, DataFrame],
                 unified: DataFrame | None = None) -> Models:
    """All models keyed by model name, built lazily.

    ``raws`` holds ``yellow``, ``green``, ``hvfhv`` and ``zone`` raw feeds.
    A materialised ``unified`` table may be passed to reuse it.
    """
    return Models(spark, raws, {M.UNIFIED: unified} if unified is not None else None)


def run(spark: SparkSession, raws: dict[str, DataFrame], out_dir: str,
        lookback_days: int = 1, ignore_after=None, as_of=None) -> DataFrame:
    """Materialise every table under ``out_dir`` and return the check report.

    A second call with new raw data loads the fact incrementally.
    """
    def path(name: str) -> str:
        return os.path.join(out_dir, name)

    lazy = build_models(spark, raws)
    # partitioned by pickup_date: the incremental fact batch reads only the dates it loads
    (lazy[M.UNIFIED].hint("rebalance", PARTITION_COLUMN).write.mode("overwrite")
     .partitionBy(PARTITION_COLUMN).parquet(path(M.UNIFIED)))
    unified = spark.read.schema(CANONICAL).parquet(path(M.UNIFIED)).select(*CANONICAL_COLUMNS)
    for name in (M.ANOMALIES, AUDIT, M.STG_ZONES, M.DIM_ZONES,
                 M.DIM_DATE, M.DIM_CLASS, M.DIM_PAYMENT):
        lazy[name].write.mode("overwrite").parquet(path(name))
    written = {n: spark.read.parquet(path(n)) for n in (
        M.ANOMALIES, M.STG_ZONES, M.DIM_ZONES, M.DIM_DATE, M.DIM_CLASS, M.DIM_PAYMENT)}

    suite = M.full_suite(as_of)
    load_checks = LoadChecks(spark, [c for c in suite if c.model == M.FACT], written)
    upsert_fact_table(spark, path(M.FACT), unified, written[M.DIM_ZONES], written[M.DIM_CLASS],
                      lookback_days=lookback_days, ignore_after=ignore_after, checks=load_checks,
                      cluster=CLUSTER)

    tables = Models(spark, raws, {**written, M.UNIFIED: unified,
                                  M.FACT: spark.read.schema(FACT).parquet(path(M.FACT)).select(*FACT_COLUMNS)})
    report = run_checks(spark, tables, suite, load_checks.known(PartitionedTable(spark, path(M.FACT), PARTITION_COLUMN)))
    report.write.mode("overwrite").parquet(path("check_report"))
    return spark.read.parquet(path("check_report"))
