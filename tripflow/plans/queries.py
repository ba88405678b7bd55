"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.

Inputs are the raw feeds Spark derives from the test tables under ``sf_dir``
(see ``sources.fixtures``); every query runs over the whole derived feeds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import rejects
from tripflow.operators.dims import calendar_counts
from tripflow.operators.classify import FEEDS, classify
from tripflow.operators.fact import build_fact
from tripflow.operators.incremental import PARTITION_COLUMN, incremental_fact, upsert_fact_table
from tripflow.operators.ledger import IngestLedger
from tripflow.operators.partitioned import PartitionedTable, writing_session
from tripflow.operators.unify import all_trips, day_sizes, first_by_day, unify_trips
from tripflow.plans import checks as C
from tripflow.plans import suite as M
from tripflow.plans.load_checks import LoadChecks, key_counts
from tripflow.plans.models import AUDIT, Models, build_models
from tripflow.session import scratch_path
from tripflow.sources import schemas as S
from tripflow.sources.fixtures import materialize_raw_feeds, raw_feeds
from tripflow.sources.schemas import CANONICAL, CANONICAL_COLUMNS, TRIP_KEY
from tripflow.streaming.dedup import start_dedup
from tripflow.streaming.delivery import deliver_arrived

# Fixed parameters of the registered queries (the oracle uses the same ones).
AS_OF = "2026-12-03 00:00:00"          # check clock for future trips
INCREMENTAL_CUT = "2024-02-29"         # first load takes pickups up to this date
IGNORE_AFTER = "2026-12-03 00:00:00"   # as-of bound for the max date in the guarded increment
WITHIN_PCT_THRESHOLD = 10

Query = Callable[[SparkSession, str], DataFrame]


def _models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build_models(spark, raw_feeds(spark, sf_dir))


def _stored_models(spark: SparkSession, sf_dir: str) -> Models:
    """The models over a unified table that is written once, for queries that read it more than once."""
    raws = raw_feeds(spark, sf_dir)
    path = scratch_path(spark, "unified")
    build_models(spark, raws)[M.UNIFIED].write.option("compression", "zstd").parquet(path)
    return build_models(spark, raws, spark.read.schema(CANONICAL).parquet(path))


def _bucketed_models(spark: SparkSession, sf_dir: str) -> Models:
    """The same, with the unified table in buckets of the trip key, as the deduplication has dealt it: groups by the
    key over it, or over the fact that is built from it, need no shuffle.

    Buckets are known to the catalog only; the name goes again, the files and what was read by it stay.
    """
    raws = raw_feeds(spark, sf_dir)
    staged = build_models(spark, raws)
    trips = unify_trips(staged[M.STG_YELLOW], staged[M.STG_GREEN], staged[M.STG_HVFHV], TRIP_KEY)
    path = scratch_path(spark, "unified")
    name, buckets = f"tripflow_{path.rsplit('-', 1)[1]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    (trips.write.bucketBy(buckets, *TRIP_KEY).option("compression", "zstd")
     .option("parquet.compression.codec.zstd.level", 1)     # read a few times and left: as small here, less work
     .option("path", path).saveAsTable(name, format="parquet"))
    unified = spark.table(name)
    spark.sql(f"drop table {name}")
    return build_models(spark, raws, unified)


def _dealt_models(spark: SparkSession, sf_dir: str) -> Models:
    """The same, with the unified table in folders of days, as the deduplication has dealt it, in a session that
    writes what it reads from it without a shuffle or a sort."""
    own = writing_session(spark)
    raws = raw_feeds(own, sf_dir)
    staged = build_models(own, raws)
    trips = all_trips(staged[M.STG_YELLOW], staged[M.STG_GREEN], staged[M.STG_HVFHV])
    unified = PartitionedTable(own, scratch_path(own, "unified"), PARTITION_COLUMN, dealt=True)
    unified.create(first_by_day(trips, day_sizes(trips)))
    return build_models(own, raws, own.read.schema(CANONICAL).parquet(unified.path).select(*CANONICAL_COLUMNS))


def _model(name: str) -> Query:
    return lambda spark, sf_dir: _models(spark, sf_dir)[name]


def _feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    r = raw_feeds(spark, sf_dir)
    return {k: r[k] for k in ("yellow", "green", "hvfhv")}


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key of every raw row (valid or not): class, key, count of raw rows per key."""
    parts = []
    for cls, raw in _feeds(spark, sf_dir).items():
        parts.append(classify(raw, FEEDS[cls]).select("vehicle_class", "trip_id"))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("vehicle_class", "trip_id").agg(F.count(F.lit(1)).alias("raw_rows"))


def fare_per_mile_and_tip_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _models(spark, sf_dir)[M.FACT]
    return f.select("trip_id", "vehicle_class", "fare_amount", "tip_amount",
                    "trip_distance_miles", "fare_per_mile", "tip_pct")


def duration_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _models(spark, sf_dir)[M.FACT]
    return f.select("trip_id", "vehicle_class", "pickup_at", "dropoff_at", "pickup_date",
                    "pickup_hour", "pickup_dow", "trip_duration_minutes")


def trip_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of each class per day, with the calendar attributes of the day.

    Every day that has a trip is kept, also outside the range of the calendar dimension. From the first
    to the last of all days, a day without a trip of a class has 0 trips.
    """
    m = _models(spark, sf_dir)
    # counted before the join, which then meets days instead of trips
    days = m[M.UNIFIED].groupBy("pickup_date", "vehicle_class").agg(F.count(F.lit(1)).alias("trips"))
    return calendar_counts(days)


def fct_trips_incremental(spark: SparkSession, sf_dir: str, ignore_after=None) -> DataFrame:
    """First load up to the cut date, then one faithful delete+insert run."""
    m = _stored_models(spark, sf_dir)
    unified, zones, classes = m[M.UNIFIED], m[M.DIM_ZONES], m[M.DIM_CLASS]
    first = build_fact(unified.where(F.col("pickup_date") <= F.lit(INCREMENTAL_CUT).cast("date")),
                       zones, classes)
    return incremental_fact(first, unified, zones, classes, ignore_after=ignore_after)


def fct_trips_incremental_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same, after a full load, with the max date taken over non-future pickups only."""
    m = _stored_models(spark, sf_dir)
    return incremental_fact(m[M.FACT], m[M.UNIFIED], m[M.DIM_ZONES], m[M.DIM_CLASS],
                            ignore_after=IGNORE_AFTER)


def total_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.total_mismatch(_models(spark, sf_dir)[M.FACT])


def future_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.future_trips(_models(spark, sf_dir)[M.FACT], AS_OF)


def within_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 on the fact: total vs the sum of its components, metered trips."""
    f = _models(spark, sf_dir)[M.FACT].where(F.col("vehicle_class").isin(*C.METERED_CLASSES))
    model = f.select("trip_id", "vehicle_class", "total_amount",
                     C.computed_total().alias("computed_total"))
    return C.within_percentage_failures(model, "total_amount", "computed_total", WITHIN_PCT_THRESHOLD)


def _report(kind: str | None) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        checks = [c for c in M.full_suite(AS_OF) if kind is None or c.kind == kind]
        # each kind of check of a table is a scan of its own; the deduplication is not repeated for each
        uses = [c.kind for c in checks if c.model in (M.UNIFIED, M.FACT)]
        stored = _bucketed_models if "unique_combination" in uses else _stored_models
        models = stored(spark, sf_dir) if len(uses) > 1 else _models(spark, sf_dir)
        return C.run_checks(spark, models, checks)
    return q


def _delivered(spark: SparkSession, sf_dir: str, files_per_load: int) -> str:
    """A warehouse folder into which the feeds' files were loaded a few at a time, by the ingest ledger."""
    m, out = _models(spark, sf_dir), scratch_path(spark, "arrivals")
    paths = materialize_raw_feeds(spark, sf_dir)
    deliver_arrived(spark, {f: paths[f] for f in FEEDS}, out, m[M.DIM_ZONES], m[M.DIM_CLASS], files_per_load)
    return out


def fct_trips_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after loads of what had arrived, whatever the dates: equal to the full build."""
    return spark.read.schema(S.FACT).parquet(f"{_delivered(spark, sf_dir, 10)}/{M.FACT}").select(*S.FACT_COLUMNS)


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger says of each feed after several loads: rows read, and files that were taken twice."""
    entries = IngestLedger(spark, f"{_delivered(spark, sf_dir, 7)}/ingest_ledger").entries()
    per_file = entries.groupBy("feed", "path").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("times"))
    return per_file.groupBy(F.col("feed").alias("vehicle_class")).agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("times") > 1).alias("files_taken_twice"))


def _loaded_with_checks(spark: SparkSession, sf_dir: str) -> tuple[LoadChecks, PartitionedTable]:
    """A fact table that was loaded in two steps whose jobs counted its checks."""
    m = _dealt_models(spark, sf_dir)
    own = m[M.UNIFIED].sparkSession
    checks = LoadChecks(own, [c for c in M.full_suite(AS_OF) if c.model == M.FACT], m)
    table = PartitionedTable(own, scratch_path(own, "fact"), PARTITION_COLUMN)
    first = m[M.UNIFIED].where(F.col("pickup_date") <= F.lit(INCREMENTAL_CUT).cast("date"))
    for trips in (first, m[M.UNIFIED]):
        upsert_fact_table(own, table.path, trips, m[M.DIM_ZONES], m[M.DIM_CLASS], ignore_after=IGNORE_AFTER, checks=checks,
                          dealt=True)
    return checks, table


def fct_load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of the fact's checks as its loads counted them, without a scan of the fact."""
    checks, table = _loaded_with_checks(spark, sf_dir)
    return spark.createDataFrame(sorted(checks.known(table).items()), "check_id string, failures long")


def fct_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and repeated keys of each day of the fact."""
    return key_counts(_models(spark, sf_dir)[M.FACT])


def streamed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the trips that a stream over the feeds' files appended, each once."""
    paths, out = materialize_raw_feeds(spark, sf_dir), scratch_path(spark, "stream")
    q = start_dedup(spark, {f: paths[f] for f in FEEDS}, out, max_files_per_trigger=4)
    q.awaitTermination()
    return spark.read.schema(CANONICAL).parquet(f"{out}/trips").select("trip_id", "vehicle_class", "pickup_date")


def unlabelled_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.unlabelled_rejects(_feeds(spark, sf_dir))


def registry() -> dict[str, Query]:
    return {
        "stg_yellow": _model(M.STG_YELLOW),
        "stg_green": _model(M.STG_GREEN),
        "stg_hvfhv": _model(M.STG_HVFHV),
        "stg_zones": _model(M.STG_ZONES),
        "reject_audit": _model(AUDIT),
        "trip_anomalies": _model(M.ANOMALIES),
        "unlabelled_rejects": unlabelled_rejects,
        "trips_unified": _model(M.UNIFIED),
        "trip_calendar": trip_calendar,
        "dim_zones": _model(M.DIM_ZONES),
        "fct_trips": _model(M.FACT),
        "fct_trips_incremental": fct_trips_incremental,
        "fct_trips_incremental_as_of": fct_trips_incremental_as_of,
        "fct_trips_by_arrival": fct_trips_by_arrival,
        "ingest_ledger": ingest_ledger,
        "fct_load_checks": fct_load_checks,
        "fct_key_counts": fct_key_counts,
        "streamed_trips": streamed_trips,
        "fare_per_mile_and_tip_pct": fare_per_mile_and_tip_pct,
        "duration_minutes": duration_minutes,
        "surrogate_keys": surrogate_keys,
        "total_mismatch": total_mismatch,
        "future_trips": future_trips,
        "within_percentage": within_percentage,
        "check_not_null": _report("not_null"),
        "check_unique": _report("unique"),
        "check_accepted_values": _report("accepted_values"),
        "check_relationships": _report("relationships"),
        "check_unique_combination": _report("unique_combination"),
        "check_report": _report(None),
    }
