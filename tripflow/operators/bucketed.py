"""C6/A8 without moving the target: a fact bucketed by its key.

``operators.incremental`` reads the date partitions that a batch touches and shuffles them for the anti
join. Where batches touch most dates (a feed that corrects old trips), it pays to keep the fact in
buckets of the key: the files of a bucket hold all rows of its keys, so a batch in the same buckets
meets them without an exchange of the target. Only the batch is shuffled, once, when it is written in
buckets itself.

Buckets are a property of a catalog table, so these tables live in the session's catalog; their files lie in
the given folder. A merge writes a new version of the table and then switches the name, so readers
of the old version keep their files until ``drop_old``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators.incremental import merge_increment
from tripflow.sources.schemas import TRIP_KEY

BUCKETS = 200


class BucketedTable:
    """A table in ``buckets`` buckets of ``keys``, sorted by them, under ``folder``."""

    def __init__(self, spark: SparkSession, name: str, folder: str, buckets: int = BUCKETS, keys: Sequence[str] = TRIP_KEY):
        self.spark, self.name, self.folder, self.buckets, self.keys = spark, name, folder, buckets, list(keys)

    def _write(self, df: DataFrame, name: str) -> None:
        # one task writes one bucket: as many files as buckets, whatever the number of tasks before
        (df.repartition(self.buckets, *self.keys).write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", os.path.join(self.folder, name)).saveAsTable(name))

    def versions(self) -> list[str]:
        """Names of the versions in the catalog, oldest first."""
        head = f"{self.name}__v"
        names = (t.name for t in self.spark.catalog.listTables() if t.name.startswith(head) and not t.name.endswith("_batch"))
        return sorted(names, key=lambda n: int(n[len(head):].split("_")[0]))

    def read(self) -> DataFrame:
        return self.spark.table(self.versions()[-1])

    def create(self, df: DataFrame) -> None:
        self._write(df, self._next())

    def _next(self) -> str:
        old = self.versions()
        n = int(old[-1][len(self.name) + 3:].split("_")[0]) + 1 if old else 0
        return f"{self.name}__v{n}_{uuid.uuid4().hex[:8]}"

    def merged(self, batch: DataFrame) -> DataFrame:
        """The table after delete+insert of a batch that is bucketed alike: a plan that does not move the table."""
        return merge_increment(self.read(), batch)

    def merge(self, batch: DataFrame) -> str:
        """Delete the rows whose key is in the batch, append the batch, and switch to the new version."""
        new = self._next()
        self._write(batch, f"{new}_batch")
        # a join of bucketed tables keeps the buckets, so this write needs no exchange either; broadcasting
        # the batch would, as its result has lost them
        rows = self.merged(self.spark.table(f"{new}_batch").hint("merge"))
        (rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", os.path.join(self.folder, new)).saveAsTable(new))
        self.spark.sql(f"drop table {new}_batch")
        return new

    def drop_old(self) -> None:
        """Forget all versions but the newest."""
        for name in self.versions()[:-1]:
            self.spark.sql(f"drop table {name}")
