"""A Parquet table partitioned by date whose partitions are replaced safely.

A load writes the new content of the partitions it touches once, under ``_loads/<id>`` inside the
table's folder (readers skip names with a leading underscore). Then it writes a manifest that names
the load, moves each partition into its place, and removes manifest and folder. Whatever dies:

* before the manifest exists, the table is unchanged, and the next load removes the remains;
* after that, ``recover`` finishes the moves. A partition whose new content is still under
  ``_loads`` has not been moved; one that is gone from there has. So finishing twice, or after a
  death between deletion and move, gives the same table.

A table counts as committed from its first whole write on (``_SUCCESS``); a folder without that
marker is the remains of a first write that died. Between the deletion and the move of a partition
a reader misses its rows; readers that need one state read between loads.

A load may leave a small *state* beside the rows (``_state.json``), such as counts of its checks. The
state travels in the manifest, so it always belongs to the last load; a load without one removes it.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.files import Store
from tripflow.session import session_with

MANIFEST, LOADS, COMMITTED, STATE = "_load.json", "_loads", "_SUCCESS", "_state.json"
Watch = Callable[[DataFrame], DataFrame]
# Fixed value: a task writes so many partitions side by side, without sorting (and spilling) wide rows; it sorts what is beyond
WRITE_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "64"}


def writing_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings whose writes of dealt rows need no sort."""
    return session_with(spark, WRITE_CONF)


class PartitionedTable:
    """``cluster`` names columns by which the rows of a partition are laid out: files hold ranges of them and are
    sorted, so a filter on them skips files and row groups by their statistics.

    ``dealt`` says that the rows come dealt by the column already, from a table partitioned by it or behind the
    caller's ``rebalance``: a task then holds few partitions, and the rows are not moved again. The caller best
    reads them by a session of ``writing_session``, which does not sort them either."""

    def __init__(self, spark: SparkSession, path: str, column: str, cluster: Sequence[str] = (), dealt: bool = False):
        self.spark, self.path, self.column, self.cluster, self.dealt = spark, path, column, list(cluster), dealt
        self.store = Store(spark)

    def _in(self, *names: str) -> str:
        return os.path.join(self.path, *names)

    def committed(self) -> bool:
        return self.store.exists(self._in(COMMITTED))

    def partitions(self) -> list[str]:
        """The values of the partition column that have a folder, ascending, without the null one."""
        head = f"{self.column}="
        names = (n[len(head):] for n in self.store.names(self.path) if n.startswith(head))
        return sorted(n for n in names if not n.startswith("__HIVE"))

    def _write(self, df: DataFrame, path: str, watch: Watch | None = None) -> None:
        if self.cluster:
            # the last key splits a date and value that hold a third of all rows over tasks
            df = df.repartitionByRange(self.column, *self.cluster, F.xxhash64(*df.columns))
        elif not self.dealt:
            # rebalance splits a date that holds a third of all rows over tasks, and packs quiet ones
            df = df.hint("rebalance", self.column)
        # what watches the rows comes behind that shuffle, so it runs in the tasks that write
        df = watch(df) if watch else df
        if self.cluster:
            df = df.sortWithinPartitions(self.column, *self.cluster)
        # the hexadecimal keys are half of what is written; zstd halves them, snappy does not
        (df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
         .partitionBy(self.column).parquet(path))

    def create(self, df: DataFrame, watch: Watch | None = None, state: Callable[[str], dict | None] | None = None) -> None:
        """Write the whole table; what an earlier write left behind goes.

        ``watch`` may add observations to the rows that are written, and ``state(path)`` gives the
        state from them and the written rows.
        """
        self._write(df, self.path, watch)
        self.keep(state(self.path) if state else None)

    def state(self) -> dict | None:
        """What the last load left beside the rows; None if it left nothing."""
        return json.loads(self.store.read_text(self._in(STATE))) if self.store.exists(self._in(STATE)) else None

    def keep(self, state: dict | None) -> None:
        """Put a state beside the rows, or remove it."""
        if state is not None:
            self.store.write_text(self._in(STATE), json.dumps(state))
        elif self.store.exists(self._in(STATE)):
            self.store.delete(self._in(STATE))

    def recover(self) -> dict | None:
        """Finish a load that has a manifest, and remove the remains of those that have none.

        Returns the manifest's ``info`` of the load that was finished, if there was one.
        """
        info = None
        if self.store.exists(self._in(MANIFEST)):
            manifest = json.loads(self.store.read_text(self._in(MANIFEST)))
            self._finish(manifest["load"], manifest.get("state"))
            info = manifest["info"]
        for name in self.store.names(self._in(LOADS)):
            self.store.delete(self._in(LOADS, name))
        return info

    def _finish(self, load: str, state: dict | None) -> None:
        head = f"{self.column}="
        for name in self.store.names(self._in(LOADS, load)):
            if name.startswith(head):
                self.store.delete(self._in(name))
                self.store.move(self._in(LOADS, load, name), self._in(name))
        # a first load by replacement commits the table, too
        if not self.committed():
            self.store.write_text(self._in(COMMITTED), "")
        self.keep(state)
        self.store.delete(self._in(MANIFEST))
        self.store.delete(self._in(LOADS, load))

    def replace(self, df: DataFrame, info: dict, watch: Watch | None = None,
                state: Callable[[str], dict | None] | None = None) -> None:
        """Replace the partitions that ``df`` holds by its rows; ``info`` goes into the manifest.

        ``df`` may read the table itself: it is written before anything is moved. ``watch`` and
        ``state`` as in ``create``; ``state`` is given the folder of the new partitions alone.
        """
        load = uuid.uuid4().hex
        self._write(df, self._in(LOADS, load), watch)
        found = state(self._in(LOADS, load)) if state else None
        self.store.write_text(self._in(MANIFEST), json.dumps({"load": load, "info": info, "state": found}))
        self._finish(load, found)
