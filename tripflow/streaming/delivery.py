"""Streaming delivery: raw trip files arriving over time -> the same tables as a batch build.

Not an operator of its own: it runs the batch operators on each micro-batch.
Each raw feed folder is a stream of *file names*; ``foreachBatch`` reads the
new files of a micro-batch with the batch reader, so files whose physical
types drift are converted exactly as in a batch build, and merges them into
tables partitioned by ``pickup_date``:

* unified trips: for each date the batch touches, the stored rows of that date
  and the batch rows are deduplicated together with the batch rule
  (``first_by_day``). A key hashes the raw pick-up time, so duplicates always
  meet in the same date partition and the result equals a batch build over
  all files, whatever the arrival order;
* fact: rebuilt for the touched dates from the merged unified rows (broadcast
  dimension joins);
* anomalies and audit counts: written per micro-batch under ``batch_id=<id>``.

Restarts: the checkpoint lies inside the output folder by default
(``_checkpoint``), so a later session continues where the last one ended, with
the same batch ids, and two outputs never share one. Date partitions are
written once and moved into place under a manifest
(``operators.partitioned``). A micro-batch that died is replayed by Spark after
the open load has been finished; merging its rows again changes nothing,
because a key's copies collapse to one, and the per-batch tables are
overwritten by batch id. The streaming state is only the file log in the
checkpoint; no unbounded state is held in memory.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.operators.classify import FEEDS, FLAG_COLUMNS, any_flag, classify
from tripflow.operators.fact import build_fact
from tripflow.operators.incremental import PARTITION_COLUMN
from tripflow.operators.ledger import MAX_FILES, load_arrivals
from tripflow.operators.partitioned import PartitionedTable, writing_session
from tripflow.operators.unify import canonical_columns, day_sizes, first_by_day
from tripflow.sources.readers import read_feed
from tripflow.sources.schemas import CANONICAL, CANONICAL_COLUMNS, RAW_SCHEMAS

FEED_ORDER = ("yellow", "green", "hvfhv")
# new files of one micro-batch and feed whose names the driver takes, unless the caller says less
FILES_PER_BATCH = 1000
# folder of the rows that were stored and are not in the tables yet
ARRIVED = "_arrived"
# Fixed value: the schema of Spark's file listing source
FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, feed: str, path: str, max_files_per_trigger: int) -> DataFrame:
    """The names of the files that arrive in a feed's folder; contents are not read."""
    return (spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", max_files_per_trigger)
            .option("pathGlobFilter", "*.parquet").load(path).select(F.lit(feed).alias("feed"), "path"))


def classified(spark: SparkSession, feed: str, files: list[str]) -> DataFrame:
    """The rows of some files of a feed as canonical trips with their classification."""
    c = classify(read_feed(spark, files, RAW_SCHEMAS[feed]), FEEDS[feed])
    return c.select(*canonical_columns(feed), *FLAG_COLUMNS, "valid", "rejection_reason", "audit_total_amount")


class TripSink:
    """``foreachBatch`` target that merges micro-batches into partitioned tables."""

    def __init__(self, spark: SparkSession, out_dir: str, zones: DataFrame, classes: DataFrame):
        self.spark, self.out_dir = spark, out_dir
        self.zones, self.classes = zones, classes

    def path(self, name: str) -> str:
        return os.path.join(self.out_dir, name)

    def table(self, name: str, dealt: bool = False) -> PartitionedTable:
        return PartitionedTable(self.spark, self.path(name), PARTITION_COLUMN, dealt=dealt)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        files: dict[str, list[str]] = {}
        for r in batch.select("feed", "path").collect():    # bounded by the files per trigger
            files.setdefault(r.feed, []).append(r.path)
        self.merge_files(files, batch_id)

    def merge_files(self, files: dict[str, list[str]], batch_id: int) -> None:
        """Merge the rows of some files; the same call again changes nothing."""
        self.store_files(files, batch_id)
        self.settle()

    def store_files(self, files: dict[str, list[str]], batch_id: int) -> None:
        """Store the rows of some files under the batch's number, for ``settle``; the same call again changes
        nothing. Of the classification each of the three writes computes only its own columns."""
        if not files:
            return
        parts = [classified(self.spark, f, sorted(files[f])) for f in FEED_ORDER if f in files]
        b = functools.reduce(lambda x, y: x.unionByName(y), parts)
        anomalies = b.where(any_flag()).select(
            "vehicle_class", "vendor_id", "pickup_at", "dropoff_at", "pickup_zone_id",
            "dropoff_zone_id", "fare_amount", F.col("audit_total_amount").alias("total_amount"),
            "trip_distance_miles", "rejection_reason")
        self._write_batch(anomalies, "int_trip_anomalies", batch_id)

        audit = b.groupBy("vehicle_class").agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("valid")).alias("valid_rows"),
            *[F.count_if(F.col(f)).alias(f) for f in FLAG_COLUMNS])
        self._write_batch(audit, "reject_counts", batch_id)
        self._write_batch(b.where(F.col("valid")).select(*CANONICAL_COLUMNS), ARRIVED, batch_id)

    def settle(self) -> None:
        """Merge the stored rows of all batches since the last time into the tables, and remove them.

        The rows go only when both tables hold them; merging them again changes nothing.
        """
        unified, fact = self.table("int_trips_unified", dealt=True), self.table("fct_trips", dealt=True)
        unified.recover()
        fact.recover()
        store = unified.store
        # a batch without the marker died while it was written, and is stored again
        waiting = [f"{self.path(ARRIVED)}/{n}" for n in store.names(self.path(ARRIVED))
                   if store.exists(f"{self.path(ARRIVED)}/{n}/_SUCCESS")]
        if not waiting:
            return
        own = writing_session(self.spark)
        trips = own.read.schema(CANONICAL).parquet(*waiting).select(*CANONICAL_COLUMNS)
        days = day_sizes(trips)
        info = {"batches": [w.rsplit("=", 1)[1] for w in waiting]}
        if days:
            touched = F.col(PARTITION_COLUMN).isin([d.pickup_date for d in days])
            merged = trips
            if unified.committed():
                merged = self._stored(own).where(touched).unionByName(trips)
                days = day_sizes(merged)
            unified.replace(first_by_day(merged, days), info)
            # from the stored rows, so that a replay that finds the first table done mends the second
            fact.replace(build_fact(self._stored(own).where(touched), self.zones, self.classes), info)
        for w in waiting:
            store.delete(w)

    def _stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(CANONICAL).parquet(self.path("int_trips_unified")).select(*CANONICAL_COLUMNS)

    def _write_batch(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(os.path.join(name, f"batch_id={batch_id}")))


def start_delivery(spark: SparkSession, feed_paths: dict[str, str], out_dir: str,
                   zones: DataFrame, classes: DataFrame, available_now: bool = True,
                   max_files_per_trigger: int | None = None,
                   checkpoint_location: str | None = None) -> StreamingQuery:
    """Start the delivery stream over the raw feed folders in ``feed_paths``.

    ``available_now`` processes every file present and stops (scheduled
    incremental runs); otherwise the query keeps running and picks up new
    files as they land. The checkpoint location defaults to ``_checkpoint`` in
    the output folder; it belongs to that output and must outlive the session.
    """
    streams = [new_files(spark, f, feed_paths[f], max_files_per_trigger or FILES_PER_BATCH)
               for f in FEED_ORDER if f in feed_paths]
    unioned = functools.reduce(lambda a, b: a.unionByName(b), streams)
    writer = (unioned.writeStream.foreachBatch(TripSink(spark, out_dir, zones, classes))
              .option("checkpointLocation", checkpoint_location or os.path.join(out_dir, "_checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def deliver_arrived(spark: SparkSession, feed_paths: dict[str, str], out_dir: str, zones: DataFrame,
                    classes: DataFrame, max_files: int = MAX_FILES) -> list[dict]:
    """One scheduled run without a stream: take every file that arrived since the last one.

    What was taken is in the ingest ledger (``operators.ledger``) under ``ingest_ledger`` in the output
    folder. The loads store their rows, and the last one merges them into the tables (``TripSink.settle``), so
    what a run writes grows with what arrived, not with the number of loads times the tables. Returns a
    summary of each load.
    """
    sink = TripSink(spark, out_dir, zones, classes)
    return load_arrivals(spark, feed_paths, sink.path("ingest_ledger"), sink.store_files, sink.settle, max_files)


def reject_audit_from_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The audit table over all micro-batches delivered so far (sums of batch counts)."""
    from tripflow.functions.exprs import round_half_away
    counts = spark.read.parquet(os.path.join(out_dir, "reject_counts"))
    s = counts.groupBy("vehicle_class").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("valid_rows").alias("valid_rows"),
        *[F.sum(f).alias(f) for f in FLAG_COLUMNS])
    rejected = F.col("total_rows") - F.col("valid_rows")
    return s.select("vehicle_class", "total_rows", "valid_rows", rejected.alias("rejected_rows"),
                    round_half_away(F.lit(100.0) * rejected / F.nullif(F.col("total_rows"), F.lit(0)), 2)
                    .alias("rejection_pct"), *FLAG_COLUMNS)
