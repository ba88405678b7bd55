"""Streaming deduplication with bounded state: each trip key once, whatever is delivered again.

The delivery stream (``streaming.delivery``) merges every micro-batch into stored date partitions, which
reads those partitions again. Here the stream itself remembers the keys it has seen, in Spark's state
store, and appends: no stored row is read or rewritten.

The state is bounded by event time, and the event is the *arrival* of a file, not the trip: the
watermark follows the modification times of the files, so a trip is never late because of its pick-up
date. ``dropDuplicatesWithinWatermark`` keeps a key for ``horizon`` after it arrived, and evicts it when the
watermark, which is ``horizon`` behind the newest file, has passed that. So the state holds the keys of
two ``horizon`` of deliveries at most, however long the stream runs. It lies in RocksDB on the executors'
disks, so it needs no heap; the stream's own session says so, and the caller's is left as it is. A file
whose time lies behind the watermark when it is read (written with an old date, or found late) would be
dropped by the watermark; its time is therefore raised to the time at which the micro-batch reads it, if that is asked for
(``arrival="read"``).

Of copies the first to arrive is kept, and within a micro-batch any of them (they agree in the fields
that the key hashes). Delivery after ``horizon`` writes a second row; a batch build, or a merge by
``streaming.delivery``, removes it.

The sink is a Parquet table partitioned by pick-up date with a log of committed files, so a restart from
the checkpoint neither loses nor repeats a row. A checkpoint whose state has the keys as text (written before
they were packed) is refused by Spark, not read wrongly.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.files import Store
from tripflow.operators.classify import FEEDS, classify
from tripflow.operators.incremental import PARTITION_COLUMN
from tripflow.operators.unify import canonical_columns
from tripflow.session import session_with
from tripflow.sources.schemas import CANONICAL_COLUMNS, RAW_SCHEMAS, TRIP_KEY

HORIZON = "7 days"
ARRIVED = "arrived_at"
# The keys lie on the executors' disks, with a bounded part in memory (outside the heap); a micro-batch
# saves its changes, not the whole state
_STORE = "spark.sql.streaming.stateStore"
STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
}


def arrival_time(arrival: str) -> Column:
    """When a row's file arrived: its modification time, or the time of the micro-batch that reads it."""
    if arrival not in ("file", "read"):
        raise ValueError(f"arrival is 'file' or 'read', not {arrival!r}")
    return F.col("_metadata.file_modification_time") if arrival == "file" else F.current_timestamp()


def arriving_trips(spark: SparkSession, feed: str, path: str, max_files_per_trigger: int | None = None,
                   arrival: str = "file") -> DataFrame:
    """Valid trips of a feed's folder as they arrive: the canonical columns and ``arrived_at``.

    Files must have the feed's declared types (drifting files go through ``streaming.delivery``).
    """
    reader = spark.readStream.schema(RAW_SCHEMAS[feed]).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(path).withColumn(ARRIVED, arrival_time(arrival))
    trips = classify(raw, FEEDS[feed], keep=[ARRIVED])
    return trips.where(F.col("valid")).select(*canonical_columns(feed), ARRIVED)


def first_arrivals(trips: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Each key once within ``horizon`` of its arrival; the state keeps keys that long and no longer.

    The hexadecimal ``trip_id`` crosses the shuffle and lies in the state as its 16 bytes.
    """
    packed = trips.withWatermark(ARRIVED, horizon).withColumn("trip_id", F.unhex("trip_id"))
    return packed.dropDuplicatesWithinWatermark(TRIP_KEY).withColumn("trip_id", F.lower(F.hex("trip_id")))


def state_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings whose streams keep their state by ``STATE_CONF``."""
    return session_with(spark, STATE_CONF)


def held_partitions(spark: SparkSession, checkpoint: str) -> int | None:
    """Partitions of the state of a stream that ran before, which keeps their number; None for a new one."""
    if not Store(spark).exists(os.path.join(checkpoint, "state", "0", "_metadata")):
        return None
    return spark.read.format("state-metadata").load(checkpoint).first().numPartitions


def start_dedup(spark: SparkSession, feed_paths: dict[str, str], out_dir: str, horizon: str = HORIZON,
                available_now: bool = True, max_files_per_trigger: int | None = None,
                arrival: str = "file", write_tasks: int | None = None) -> StreamingQuery:
    """Append each trip once to ``trips`` under ``out_dir``, partitioned by pick-up date.

    A micro-batch is written by ``write_tasks`` tasks, each a file of every date that it holds; by default as
    many as run at once (where executors come and go, give the number). Then the state of a new stream has as
    many partitions (the caller's shuffle partitions at most), so a task that writes has one of them, and runs on the
    executor that holds it. Tasks that combine partitions (a given number, or a stream that began with more) are
    placed by host alone: where a host has several executors, they load the state anew in most micro-batches.
    """
    own = state_session(spark)
    checkpoint, partitions = os.path.join(out_dir, "_dedup_checkpoint"), "spark.sql.shuffle.partitions"
    tasks = write_tasks or min(spark.sparkContext.defaultParallelism, int(own.conf.get(partitions)))
    if not write_tasks:
        own.conf.set(partitions, str(tasks))    # a stream that ran before keeps its number
    streams = [arriving_trips(own, f, feed_paths[f], max_files_per_trigger, arrival) for f in sorted(feed_paths)]
    every = streams[0]
    for s in streams[1:]:
        every = every.unionByName(s)
    trips = first_arrivals(every, horizon).select(*CANONICAL_COLUMNS)
    if (held_partitions(own, checkpoint) or int(own.conf.get(partitions))) > tasks:
        trips = trips.coalesce(tasks)
    writer = (trips.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
              .partitionBy(PARTITION_COLUMN).option("path", os.path.join(out_dir, "trips"))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
