"""Checks of a date-partitioned table counted while it is written, and kept up to date by its loads.

A load counts in the job that writes. Checks that look at one row are ``count_if`` columns of an
``Observation`` on the rows as they are written, behind the shuffle of the write, so no second scan
of the table is needed. The counts of the table after an incremental load are

    counts before - counts of the touched days before + counts of the touched days now,

and the rows of the touched days before are read by the merge anyway: they carry an observation, too.

Uniqueness is kept as rows and repeated keys per day. A key hashes its pick-up time, so it lives in
one day and the numbers of days add up; a load counts the keys of the days that it writes, and no
others. These rows per day also guard the observations: if a task was repeated and an observation
counted it twice, the sums differ, the state is dropped, and the next report counts by a scan.

Counts of a relationship check hold for the parent as it was; its keys are kept as a fingerprint, and
a check whose parent has changed is counted anew. ``no_future_trips`` depends on the clock and is not
kept: it reads only the days behind the clock.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.incremental import PARTITION_COLUMN
from tripflow.operators.partitioned import PartitionedTable, Watch
from tripflow.plans.checks import Check, _Parents, row_failures
from tripflow.sources.schemas import FACT, TRIP_KEY

State = Callable[[str], dict | None]


def key_counts(table: DataFrame, keys: Sequence[str] = TRIP_KEY, days: Sequence[str] | None = None) -> DataFrame:
    """(day, rows, repeated): rows of each day and its keys that occur more than once.

    With ``days`` only those partitions are read. A key lives in one day, so days can be counted apart.
    """
    if days is not None:
        table = table.where(F.col(PARTITION_COLUMN).isin([F.lit(d).cast("date") for d in days]))
    # the date itself is shuffled with each key, its text is not
    per_key = table.groupBy(PARTITION_COLUMN, *keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(F.col(PARTITION_COLUMN).cast("string").alias("day")).agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"))


class LoadChecks:
    """The checks of one table (``checks``, all of its model) whose counts its loads keep."""

    def __init__(self, spark: SparkSession, checks: Sequence[Check], tables: Mapping[str, DataFrame],
                 keys: Sequence[str] = TRIP_KEY):
        self.spark, self.keys = spark, list(keys)
        self._parents, self._tables = _Parents(tables), tables
        self._prints: dict[tuple, list] = {}
        self.unique = [c for c in checks if c.kind == "unique_combination" and list(c.columns) == self.keys]
        self.of_row = [c for c in checks if c.kind in ("not_null", "within_percentage")
                       or c.kind == "relationships" and self._parents.small(c)
                       or c.kind == "singular" and c.params.get("test") != "no_future_trips"]

    def fingerprint(self, c: Check) -> list:
        """Number and combined hash of a parent's keys. Parents are measured small."""
        if (c.to, c.field) not in self._prints:
            k = self._tables[c.to].select(F.col(c.field).cast("string").alias("k")).distinct()
            self._prints[c.to, c.field] = list(k.agg(F.count("k"), F.coalesce(F.bit_xor(F.xxhash64("k")), F.lit(0))).first())
        return self._prints[c.to, c.field]

    def watched(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """``df`` with an observation of its rows and of the failures of each row check."""
        seen = Observation()
        joined, failed = row_failures(df, self.of_row, self._parents)
        counts = [F.count_if(f).alias(f"c{i}") for i, f in enumerate(failed)]
        return joined.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).select(*df.columns), seen

    def _days(self, path: str) -> dict[str, list[int]]:
        """Rows and repeated keys of each day under ``path``: calendar days, a bounded list.

        Equal keys have equal hashes, so days without equal hashes have no repeated key: only the 8 bytes of a key's
        hash are shuffled. The keys of the other days are counted themselves.
        """
        table = self.spark.read.schema(FACT).parquet(path)
        hashes = table.select(PARTITION_COLUMN, F.xxhash64(*self.keys).alias("hash"))
        found = {r.day: [r.rows, r.repeated] for r in key_counts(hashes, ["hash"]).collect()}
        alike = [day for day, (_, repeated) in found.items() if repeated]
        if alike:
            exact = key_counts(table, self.keys, None if None in alike else alike)
            found |= {r.day: [r.rows, r.repeated] for r in exact.collect()}
        return found

    def _state(self, counts: Mapping[str, int], days: dict[str, list[int]]) -> dict:
        prints = {c.check_id: self.fingerprint(c) for c in self.of_row if c.kind == "relationships"}
        return {"counts": dict(counts), "parents": prints, "days": days}

    def _by_check(self, seen: Observation) -> dict[str, int]:
        return {c.check_id: seen.get[f"c{i}"] for i, c in enumerate(self.of_row)}

    def of_build(self) -> tuple[Watch, State]:
        """(watch, state) of a full build, for ``PartitionedTable.create``."""
        seen: list[Observation] = []

        def watch(df: DataFrame) -> DataFrame:
            df, o = self.watched(df)
            seen.append(o)
            return df

        def state(path: str) -> dict | None:
            days = self._days(path)
            if seen[0].get["rows"] != sum(rows for rows, _ in days.values()):
                return None
            return self._state(self._by_check(seen[0]), days)
        return watch, state

    def of_load(self, before: dict | None, old: DataFrame, days: Sequence[str],
                empty: bool = False) -> tuple[DataFrame, Watch, State]:
        """(rows of the touched days before, watch, state) of a load, for ``PartitionedTable.replace``.

        ``before`` is the table's state, ``old`` its rows of the touched ``days``. If it is known that there are none
        (``empty``), the load need not read them.
        """
        watch, build = self.of_build()
        current = before if before is not None and self._current(before) else None
        if current is None:                     # nothing to go on: the next report counts by a scan
            return old, lambda df: df, lambda path: None
        gone = None
        if not empty:
            old, gone = self.watched(old)

        def state(path: str) -> dict | None:
            now = build(path)
            rows = gone.get["rows"] if gone else 0
            if now is None or rows != sum(current["days"].get(d, [0, 0])[0] for d in days):
                return None
            was = self._by_check(gone) if gone else dict.fromkeys(now["counts"], 0)
            counts = {k: current["counts"][k] - was[k] + n for k, n in now["counts"].items()}
            return self._state(counts, {d: v for d, v in current["days"].items() if d not in set(days)} | now["days"])
        return old, watch, state

    def _current(self, state: dict) -> bool:
        """Whether the state's counts are of these checks and of the parents as they are."""
        return set(state["counts"]) == {c.check_id for c in self.of_row} and all(
            state["parents"].get(c.check_id) == self.fingerprint(c) for c in self.of_row if c.kind == "relationships")

    def known(self, table: PartitionedTable) -> dict[str, int]:
        """Counts of the table's checks that need no scan. A table without a state is counted once, by a
        scan, and has one from then on."""
        state = table.state()
        if state is None or not self._current(state):
            state = self.recount(table)
        repeated = sum(n for _, n in state["days"].values())
        return dict(state["counts"]) | {c.check_id: repeated for c in self.unique}

    def recount(self, table: PartitionedTable) -> dict:
        """Count the whole table and keep the result as its state."""
        rows = self.spark.read.schema(FACT).parquet(table.path)
        joined, failed = row_failures(rows, self.of_row, self._parents)
        counts = joined.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(f).alias(f"c{i}") for i, f in enumerate(failed)]).first()
        state = self._state({c.check_id: counts[f"c{i}"] for i, c in enumerate(self.of_row)}, self._days(table.path))
        table.keep(state)
        return state
