"""Data-quality checks J1-J9 and the report that runs a suite of them.

A check is a query over one table; its failure count decides the status
(``pass``, or ``warn``/``fail`` by severity). Counting rules follow the
check library the reference uses:

* ``not_null``: rows with a NULL value.
* ``unique``: distinct non-NULL values occurring more than once.
* ``accepted_values``: distinct non-NULL values outside the list (NULL passes).
* ``relationships``: child rows whose non-NULL key has no parent (NULL passes).
* ``unique_combination``: column combinations occurring more than once.
* ``within_percentage``: rows deviating more than ``threshold_pct`` percent.
* singular checks (``no_future_trips``, ``total_equals_components``): rows returned.

Execution plan of ``run_checks``, per table:

* checks that look at one row (not_null, row predicates, relationships to parents measured small)
  are ``count_if`` columns of one global aggregate, with the parents' keys as broadcast left joins.
  No row is exploded, nothing is shuffled but one partial row per task;
* accepted_values groups only the offending rows;
* unique and unique_combination group their typed columns, one shuffle each, partially aggregated
  map-side (a key holding a third of the rows is one row per task);
* relationships to larger parents join distinct keys.

Nothing is collected.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections import defaultdict
from collections.abc import Mapping, Sequence
import dataclasses
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.exprs import boundaries_between, pct_deviation
from tripflow.operators.joins import is_small, orphan_rows

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    check_id: str
    kind: str                      # not_null | unique | accepted_values | relationships | unique_combination | singular
    model: str
    columns: tuple[str, ...] = ()
    values: tuple = ()             # accepted_values
    to: str | None = None          # relationships: parent table
    field: str | None = None       # relationships: parent column
    severity: str = ERROR
    params: dict = dataclasses.field(default_factory=dict, hash=False, compare=False)

    @property
    def column(self) -> str | None:
        return ",".join(self.columns) if self.columns else None


# ---- failing-row queries, one per check kind (the rows a check returns) ----

def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-NULL values with their row counts."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    c = F.col(column)
    return (df.where(c.isNotNull() & ~c.isin(list(values))).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")))


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, field_: str) -> DataFrame:
    """Non-NULL child keys with no parent, with the child rows per key."""
    return orphan_rows(child, column, parent, field_)


def unique_combination_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations occurring more than once (NULLs group together)."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def within_percentage_failures(df: DataFrame, column: str, compare_column: str,
                               threshold_pct: float = 10) -> DataFrame:
    """Rows whose ``column`` deviates from ``compare_column`` by more than the
    threshold, with ``deviation_pct``. A NULL or zero base is never flagged."""
    dev = pct_deviation(column, compare_column)
    return (df.where(F.col(compare_column).isNotNull() & F.col(column).isNotNull()
                     & (dev > F.lit(float(threshold_pct))))
            .select("*", dev.alias("deviation_pct")))


def as_of_column(as_of: dt.datetime | str | None) -> Column:
    """The check clock: a fixed wall-clock time, or the session's local time."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def picked_up_after(fact: DataFrame, now: Column) -> Column:
    """Picked up after ``now``. The date condition follows from the other one; where the table has the
    date it is stated, so that only later partitions are read."""
    after = F.col("pickup_at") > now
    return (F.col("pickup_date") >= now.cast("date")) & after if "pickup_date" in fact.columns else after


def future_trips(fact: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Trips picked up after ``as_of``, with the hour boundaries in between."""
    now = as_of_column(as_of)
    return fact.where(picked_up_after(fact, now)).select(
        "trip_id", "vehicle_class", "pickup_at",
        now.alias("checked_at"),
        boundaries_between("hour", now, F.col("pickup_at")).alias("hours_in_future"),
    )


# Components summed by the total check, in order, and its tolerance.
TOTAL_COMPONENTS = ("tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee",
                    "extra", "mta_tax", "improvement_surcharge")
TOTAL_TOLERANCE = 5.00
METERED_CLASSES = ("yellow", "green")


def computed_total() -> Column:
    total = F.col("fare_amount")
    for c in TOTAL_COMPONENTS:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    return total


def total_mismatch(fact: DataFrame, tolerance: float = TOTAL_TOLERANCE) -> DataFrame:
    """Metered trips whose total differs from its components by more than ``tolerance``."""
    comp = computed_total()
    disc = F.abs(F.col("total_amount") - comp)
    return (fact.where(F.col("vehicle_class").isin(*METERED_CLASSES) & (disc > F.lit(tolerance)))
            .select("trip_id", "vehicle_class", "total_amount",
                    comp.alias("computed_total"), disc.alias("discrepancy")))


SINGULAR = {
    "no_future_trips": lambda t, p: future_trips(t, p.get("as_of")),
    "total_equals_components": lambda t, p: total_mismatch(t, p.get("tolerance", TOTAL_TOLERANCE)),
}

# The same checks as row predicates, so they fold into the table's fused scan.
ROW_PREDICATES = {
    "no_future_trips": lambda p: F.col("pickup_at") > as_of_column(p.get("as_of")),
    "total_equals_components": lambda p: (
        F.col("vehicle_class").isin(*METERED_CLASSES)
        & (F.abs(F.col("total_amount") - computed_total()) > F.lit(p.get("tolerance", TOTAL_TOLERANCE)))),
}


def _row_predicate(c: Check) -> Column:
    if c.kind == "within_percentage":
        col, base = c.columns[0], c.params["compare_column"]
        dev = pct_deviation(col, base)
        return (F.col(base).isNotNull() & F.col(col).isNotNull()
                & (dev > F.lit(float(c.params.get("threshold_pct", 10)))))
    return ROW_PREDICATES[c.params["test"]](c.params)


# ---- the suite runner ----

def failing_rows(tables: Mapping[str, DataFrame], c: Check) -> DataFrame:
    """The rows check ``c`` returns, one query per check (for inspection).

    ``run_checks`` computes the same failure counts fused per table; this is the
    straightforward form: rows for not_null, relationships (with ``_rows`` per
    orphan key) and singular checks, one row per offending value or key otherwise.
    """
    t = tables[c.model]
    if c.kind == "not_null":
        return not_null_failures(t, c.columns[0])
    if c.kind == "unique":
        return unique_failures(t, c.columns[0])
    if c.kind == "accepted_values":
        return accepted_values_failures(t, c.columns[0], c.values)
    if c.kind == "relationships":
        return relationships_failures(t, c.columns[0], tables[c.to], c.field)
    if c.kind == "unique_combination":
        return unique_combination_failures(t, c.columns)
    if c.kind == "within_percentage":
        return within_percentage_failures(t, c.columns[0], c.params["compare_column"],
                                          c.params.get("threshold_pct", 10))
    return SINGULAR[c.params["test"]](t, c.params)


COLUMN_KINDS = ("not_null", "unique", "accepted_values", "relationships", "unique_combination",
                "within_percentage", "singular")


class _Parents:
    """Parent keys of relationship checks; each parent column is measured once per suite run."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables, self._small = tables, {}

    def keys(self, c: Check, child: DataFrame) -> DataFrame:
        """The parent's keys in the child column's type, without NULLs."""
        ctype = child.schema[c.columns[0]].dataType
        return self.tables[c.to].select(F.col(c.field).cast(ctype).alias("_k")).where(F.col("_k").isNotNull())

    def small(self, c: Check) -> bool:
        if (c.to, c.field) not in self._small:
            self._small[c.to, c.field] = is_small(self.tables[c.to].select(c.field))
        return self._small[c.to, c.field]


def row_failures(df: DataFrame, checks: list[Check], parents: _Parents) -> tuple[DataFrame, list[Column]]:
    """``df`` with the parents' keys joined to it, and a condition per check that looks at one row."""
    failed: list[Column] = []
    joined: dict[tuple, str] = {}
    for c in checks:
        if c.kind == "not_null":
            failed.append(F.col(c.columns[0]).isNull())
        elif c.kind == "relationships":
            key = (c.columns[0], c.to, c.field)
            if key not in joined:
                found = joined[key] = f"_parent{len(joined)}"
                keys = F.broadcast(parents.keys(c, df).distinct().withColumn(found, F.lit(True)))
                df = df.join(keys, F.col(c.columns[0]) == F.col("_k"), "left").drop("_k")
            failed.append(F.col(c.columns[0]).isNotNull() & F.col(joined[key]).isNull())
        else:
            failed.append(_row_predicate(c))
    return df, failed


def _row_checks(df: DataFrame, checks: list[Check], parents: _Parents) -> DataFrame:
    """Checks that look at one row: one ``count_if`` each, in one global aggregate."""
    df, failed = row_failures(df, checks, parents)
    counts = df.agg(*[F.count_if(f).alias(f"c{i}") for i, f in enumerate(failed)])
    # one row from here on
    pairs = F.array(*[F.struct(F.lit(c.check_id).alias("check_id"), F.col(f"c{i}").alias("failures"))
                      for i, c in enumerate(checks)])
    return counts.select(F.inline(pairs))


def _domain_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """accepted_values: distinct offending values; only offending rows are expanded."""
    bad = [F.col(c.columns[0]).isNotNull() & ~F.col(c.columns[0]).isin(list(c.values)) for c in checks]
    pairs = F.array(*[F.when(b, F.struct(F.lit(c.check_id).alias("check_id"),
                                         F.col(c.columns[0]).cast("string").alias("value")))
                      for b, c in zip(bad, checks, strict=True)])
    rows = df.where(functools.reduce(lambda x, y: x | y, bad)).select(F.explode(pairs).alias("p"))
    return (rows.where(F.col("p").isNotNull()).select("p.*").distinct()
            .groupBy("check_id").agg(F.count(F.lit(1)).alias("failures")))


def _one_count(c: Check, rows: DataFrame, failures: Column) -> DataFrame:
    return rows.agg(failures.cast("bigint").alias("failures")).select(F.lit(c.check_id).alias("check_id"), "failures")


def _column_check_counts(df: DataFrame, checks: list[Check], parents: _Parents) -> list[DataFrame]:
    """(check_id, failures) of every check of one table, in as few passes as their kinds need."""
    of_row, domain, parts = [], [], []
    for c in checks:
        if c.kind == "accepted_values":
            domain.append(c)
        elif c.kind == "unique":
            parts.append(_one_count(c, unique_failures(df, c.columns[0]), F.count(F.lit(1))))
        elif c.kind == "unique_combination":
            parts.append(_one_count(c, unique_combination_failures(df, c.columns), F.count(F.lit(1))))
        elif c.kind == "relationships" and not parents.small(c):
            orphans = orphan_rows(df, c.columns[0], parents.keys(c, df), "_k", broadcast_parent=False)
            parts.append(_one_count(c, orphans, F.coalesce(F.sum("_rows"), F.lit(0))))
        else:
            of_row.append(c)
    future = [c for c in of_row if c.params.get("test") == "no_future_trips"]
    if future == of_row:
        # nothing else needs the rows: only the partitions behind the clock are read
        parts += [_one_count(c, future_trips(df, c.params.get("as_of")), F.count(F.lit(1))) for c in future]
    else:
        parts.append(_row_checks(df, of_row, parents))
    if domain:
        parts.append(_domain_checks(df, domain))
    return parts


def check_failures(tables: Mapping[str, DataFrame], checks: Sequence[Check],
                   known: Mapping[str, int] | None = None) -> DataFrame:
    """(check_id, failures) of the checks; an id that is absent means 0.

    ``known`` has counts that need no job, such as those of ``plans.load_checks``.
    """
    known = {c.check_id: known[c.check_id] for c in checks if c.check_id in (known or {})}
    checks = [c for c in checks if c.check_id not in known]
    by_model: dict[str, list[Check]] = defaultdict(list)
    for c in checks:
        if c.kind not in COLUMN_KINDS:
            raise ValueError(f"unknown check kind {c.kind}")
        by_model[c.model].append(c)
    parents = _Parents(tables)
    parts = [p for model, group in by_model.items() for p in _column_check_counts(tables[model], group, parents)]
    if known:
        spark = next(iter(tables.values())).sparkSession if not parts else parts[0].sparkSession
        parts.append(spark.createDataFrame(list(known.items()), "check_id string, failures long"))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def run_checks(spark: SparkSession, tables: Mapping[str, DataFrame], checks: Sequence[Check],
               known: Mapping[str, int] | None = None) -> DataFrame:
    """The report, one row per check: id, kind, model, column, severity, failures, status.

    Checks whose count is in ``known`` read no table.
    """
    meta = spark.createDataFrame(
        [(c.check_id, c.kind, c.model, c.column, c.severity) for c in checks],
        "check_id string, check_kind string, model string, column_name string, severity string")
    fails = check_failures(tables, checks, known)
    # at most one row per check in the suite (a size fixed by the suite, not the data)
    rep = meta.join(F.broadcast(fails), "check_id", "left").withColumn(
        "failures", F.coalesce(F.col("failures"), F.lit(0)).cast("bigint"))
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == WARN, F.lit("warn")).otherwise(F.lit("fail")))
    return rep.select("check_id", "check_kind", "model", "column_name", "severity",
                      "failures", status.alias("status"))


def overall_status(report: DataFrame) -> DataFrame:
    """One row: counts per status and ``ok`` = no error-severity failure."""
    return report.agg(
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
        F.count_if(F.col("status") == "fail").alias("failed"),
        (F.count_if(F.col("status") == "fail") == 0).alias("ok"),
    )
