"""Command line: ``python -m tripflow {build,check,load,stream} ...`` (or via spark-submit).

build   read the raw feeds, write every table under --out (the fact loads
        incrementally when it already exists) and write the check report
check   run the 114 checks against the tables under --out and print the report
load    take the raw files that arrived since the last load (ingest ledger), whatever their dates
stream  deliver raw files as they land (file streams -> foreachBatch merge)

The session comes from the launcher (spark-submit / cluster defaults); the
tool never overrides its configuration.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession


def _raws(spark: SparkSession, a: argparse.Namespace):
    from tripflow.sources.readers import read_feed, read_zone_csv
    from tripflow.sources.schemas import RAW_SCHEMAS
    if getattr(a, "skip_malformed", False):
        from tripflow.sources import malformed
        raws, report = {}, malformed.zone_report(spark, a.zones)
        for f in ("yellow", "green", "hvfhv"):
            raws[f], bad = malformed.read_sound_feed(spark, f, getattr(a, f), RAW_SCHEMAS[f])
            report = report.unionByName(bad)
        report.write.mode("overwrite").parquet(os.path.join(a.out, "malformed_inputs"))
        return raws | {"zone": malformed.sound_zones(spark, a.zones)}
    raws = {f: read_feed(spark, getattr(a, f), RAW_SCHEMAS[f])
            for f in ("yellow", "green", "hvfhv")}
    raws["zone"] = read_zone_csv(spark, a.zones)
    return raws


def _tables(spark: SparkSession, a: argparse.Namespace):
    from tripflow.plans import suite as M
    from tripflow.plans.models import AUDIT, Models
    from tripflow.sources.schemas import CANONICAL, CANONICAL_COLUMNS, FACT, FACT_COLUMNS
    written = {n: spark.read.parquet(os.path.join(a.out, n)) for n in (
        M.ANOMALIES, AUDIT, M.STG_ZONES, M.DIM_ZONES, M.DIM_DATE, M.DIM_CLASS, M.DIM_PAYMENT)}
    written[M.UNIFIED] = spark.read.schema(CANONICAL).parquet(
        os.path.join(a.out, M.UNIFIED)).select(*CANONICAL_COLUMNS)
    written[M.FACT] = spark.read.schema(FACT).parquet(os.path.join(a.out, M.FACT)).select(*FACT_COLUMNS)
    return Models(spark, _raws(spark, a), written)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tripflow", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("build", "check", "load", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--yellow", required=True, help="yellow raw Parquet path or glob")
        s.add_argument("--green", required=True, help="green raw Parquet path or glob")
        s.add_argument("--hvfhv", required=True, help="ride-hail raw Parquet path or glob")
        s.add_argument("--zones", required=True, help="zone lookup CSV")
        s.add_argument("--out", required=True, help="output folder of the tables")
        s.add_argument("--as-of", default=None, help="check clock (default: session local time)")
        if name == "build":
            s.add_argument("--lookback-days", type=int, default=1)
            s.add_argument("--ignore-after", default=None)
            s.add_argument("--skip-malformed", action="store_true",
                           help="leave unreadable files and zone rows out, and report them in malformed_inputs")
        if name == "stream":
            s.add_argument("--continuous", action="store_true",
                           help="keep running (default: process available files and stop)")
            s.add_argument("--checkpoint", default=None,
                           help="folder of the stream's progress (default: _checkpoint under --out)")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tripflow-{a.cmd}").getOrCreate()

    from tripflow.plans import suite as M
    suite = M.full_suite(a.as_of)
    if a.cmd == "build":
        from tripflow.plans import models
        report = models.run(spark, _raws(spark, a), a.out, lookback_days=a.lookback_days,
                            ignore_after=a.ignore_after, as_of=a.as_of)
        report.where("status != 'pass'").show(len(suite), truncate=False)
        return 1 if report.where("status = 'fail'").limit(1).count() else 0
    if a.cmd == "check":
        from tripflow.operators.incremental import PARTITION_COLUMN
        from tripflow.operators.partitioned import PartitionedTable
        from tripflow.plans.checks import run_checks
        from tripflow.plans.load_checks import LoadChecks
        tables = _tables(spark, a)
        fact = PartitionedTable(spark, os.path.join(a.out, M.FACT), PARTITION_COLUMN)
        known = LoadChecks(spark, [c for c in suite if c.model == M.FACT], tables).known(fact)
        report = run_checks(spark, tables, suite, known)
        report.show(len(suite), truncate=False)
        return 1 if report.where("status = 'fail'").limit(1).count() else 0
    from tripflow.operators import dims, staging
    from tripflow.sources.readers import read_zone_csv
    from tripflow.streaming.delivery import deliver_arrived, start_delivery
    zones = dims.dim_zones(staging.stage_zones(read_zone_csv(spark, a.zones)))
    paths = {f: getattr(a, f) for f in ("yellow", "green", "hvfhv")}
    if a.cmd == "load":
        for load in deliver_arrived(spark, paths, a.out, zones, dims.dim_vehicle_class(spark)):
            print(load)
        return 0
    q = start_delivery(spark, paths, a.out, zones, dims.dim_vehicle_class(spark), available_now=not a.continuous,
                       checkpoint_location=a.checkpoint)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
