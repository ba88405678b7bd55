"""Loading by what arrived: an ingest ledger instead of a date rule.

The faithful incremental rule (``operators.incremental``) selects by pick-up date, so a late row
is lost and a future-dated one freezes loading. Here a load takes the *files* that it has not taken
yet, whatever dates their rows carry:

* the ledger holds a row per input file: feed, path, length and modification time of the listing,
  the rows it held and the load that took it;
* files present are listed by Spark (contents are not read) and anti-joined to the ledger. What
  remains is taken oldest first, at most ``max_files`` in one load, until nothing is left;
* a load merges the rows of its files by date partition with the batch dedup rule, so a key that
  was delivered before stays one row, and the tables equal a full build over all files.

A load is exactly-once. Its files are first named in a note (``_open.json``), then its rows are stored
under the load's number, then the ledger gets its rows, then the note goes. A run that dies
in between leaves the note, and the next run repeats that load with the same files and number:
what is stored is overwritten by number.

The tables are merged once in a run, by its last load and before that one is recorded: every load has rows
of most dates, so a merge in each would write the tables anew as often as there are loads. If a run dies
before, the rows stored by the loads so far are merged by the next run, whether or not a file arrived.

Files are taken as immutable: one that was written anew (another length or time) is a new arrival.
Files that cannot be read are reported in the ledger and not tried again until they change.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.files import Store
from tripflow.sources.malformed import split_readable
from tripflow.sources.schemas import RAW_SCHEMAS

FILE_KEY = ["feed", "path", "length", "modified"]
ENTRY = "feed string, path string, length long, modified long, rows long, status string"
LOADED, UNREADABLE = "loaded", "unreadable"
NOTE = "_open.json"
# files that one load takes, whose names the driver holds
MAX_FILES = 1000


def arrived_files(spark: SparkSession, feed_paths: Mapping[str, str]) -> DataFrame:
    """(feed, path, length, modified) of the Parquet files present; contents are not read. ``modified`` is in
    microseconds, the same number in a session of any time zone."""
    parts = [spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(
        F.lit(feed).alias("feed"), "path", "length", F.unix_micros("modificationTime").alias("modified"))
        for feed, path in sorted(feed_paths.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class IngestLedger:
    """The ledger of one warehouse: a Parquet folder with a sub-folder per load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.store = spark, path, Store(spark)

    def _in(self, *names: str) -> str:
        return os.path.join(self.path, *names)

    def loads(self) -> list[int]:
        """Numbers of the loads that are recorded in full."""
        names = (n for n in self.store.names(self.path) if n.startswith("load="))
        return sorted(int(n[5:]) for n in names if self.store.exists(self._in(n, "_SUCCESS")))

    def entries(self) -> DataFrame:
        """All rows, with the number of their load."""
        done = self.loads()
        if not done:
            return self.spark.createDataFrame([], ENTRY + ", load int")
        return self.spark.read.schema(ENTRY).parquet(*[self._in(f"load={n}") for n in done]).withColumn(
            "load", F.regexp_extract(F.col("_metadata.file_path"), r"/load=(\d+)/", 1).cast("int"))

    def pending(self, files: DataFrame) -> DataFrame:
        """The listed files that no load has taken in their present form."""
        return files.join(self.entries().select(*FILE_KEY), FILE_KEY, "left_anti")

    def open_load(self) -> dict | None:
        """The load that an earlier run began and did not finish."""
        return json.loads(self.store.read_text(self._in(NOTE))) if self.store.exists(self._in(NOTE)) else None

    def begin(self, files: list[dict]) -> dict:
        """Name the files of the next load."""
        load = {"load": max(self.loads(), default=-1) + 1, "files": files}
        self.store.write_text(self._in(NOTE), json.dumps(load))
        return load

    def finish(self, load: dict, rows: Mapping[str, int], unreadable: list[str]) -> None:
        """Record the files of a load whose tables are merged, and close it."""
        bad = set(unreadable)
        entries = [(f["feed"], f["path"], f["length"], f["modified"], rows.get(f["path"]),
                    UNREADABLE if f["path"] in bad else LOADED) for f in load["files"]]
        self.spark.createDataFrame(entries, ENTRY).coalesce(1).write.mode("overwrite").parquet(self._in(f"load={load['load']}"))
        self.store.delete(self._in(NOTE))


def load_arrivals(spark: SparkSession, feed_paths: Mapping[str, str], ledger_path: str,
                  store: Callable[[dict[str, list[str]], int], None], settle: Callable[[], None],
                  max_files: int = MAX_FILES) -> list[dict]:
    """Take every file that has arrived and was not taken yet; returns a summary of each load.

    ``store(files by feed, load number)`` stores the rows of some files, ``settle()`` merges what was stored
    into the tables. Both must have the same effect when they are called again.
    """
    ledger = IngestLedger(spark, ledger_path)
    done = []
    while True:
        load, resumed, last = ledger.open_load(), True, True
        if load is None:
            resumed = False
            # oldest first; one more tells whether this load is the last one
            rows = ledger.pending(arrived_files(spark, feed_paths)).orderBy("modified", "path").limit(max_files + 1).select(*FILE_KEY).collect()
            if not rows:
                settle()
                return done
            last = len(rows) <= max_files
            load = ledger.begin([r.asDict() for r in rows[:max_files]])
        by_feed: dict[str, list[str]] = {}
        for f in load["files"]:
            by_feed.setdefault(f["feed"], []).append(f["path"])
        counts, unreadable = {}, []
        for feed, files in by_feed.items():
            good, bad = split_readable(spark, sorted(files), RAW_SCHEMAS[feed])
            counts |= good
            unreadable += bad
            by_feed[feed] = sorted(good)
        store({k: v for k, v in by_feed.items() if v}, load["load"])
        if last:
            settle()
        ledger.finish(load, counts, unreadable)
        done.append({"load": load["load"], "files": len(load["files"]), "rows": sum(counts.values()),
                     "unreadable": unreadable, "resumed": resumed})
