"""Sources A1-A4: raw Parquet feeds, the zone CSV, literal relations, date spine.

Raw trip files drift in physical type (int32, int64, double) and in the case
of column names. ``read_feed`` finds the sets of files that share physical
types, reads each with its own types, casts to the declared schema and unions
by name. Types are found by Spark's own distributed schema merge over many
files at once: a merge that fails splits the files, so the number of jobs
follows the number of changes of type, not the number of files.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.files import plain
from tripflow.sources.schemas import ZONE_RAW


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns (case-insensitive) cast to the declared types.

    Declared columns missing from ``df`` become typed NULLs, extra columns are
    dropped. A double read into an integer column is rounded half to even.
    """
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{src.name}`")
        if src.dataType == f.dataType:
            cols.append(c.alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType)) and isinstance(
                src.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(F.rint(c.cast("double")).cast(f.dataType).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def same_typed(spark: SparkSession, files: list[str]) -> Iterator[tuple[list[str], T.StructType]]:
    """(files, schema) of sets of files whose columns have the same physical types.

    ``files`` are in order; files of one period mostly agree, so few splits are needed.
    """
    try:
        schema = spark.read.option("mergeSchema", "true").parquet(*files).schema
    except (PySparkException, Py4JJavaError) as e:  # Spark raises one or the other, by version
        if len(files) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        half = len(files) // 2
        yield from same_typed(spark, files[:half])
        yield from same_typed(spark, files[half:])
        return
    yield files, schema


def feed_files(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> list[str]:
    """The files behind paths, folders or globs, sorted. Nothing is read."""
    return sorted(map(plain, spark.read.format("parquet").schema(schema).load(_as_list(paths)).inputFiles()))


def read_feed(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """A1: Parquet glob scan of one raw feed on its declared schema.

    Each set of equally typed files is one scan: filters are pushed down and
    columns pruned in each. Sets of equal schema are read together.
    """
    files = feed_files(spark, paths, schema)
    if not files:
        return spark.createDataFrame([], schema)
    sets: dict[str, tuple[list[str], T.StructType]] = {}
    for some, found in same_typed(spark, files):
        sets.setdefault(found.json(), ([], found))[0].extend(some)
    parts = [conform(spark.read.schema(found).parquet(*some), schema) for some, found in sets.values()]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """A2: zone lookup CSV with a header. Empty fields read as NULL, ``N/A`` stays text."""
    return spark.read.csv(path, header=True, schema=ZONE_RAW)


def literal_relation(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A3: an inline ``VALUES`` relation (a local relation, broadcast for free)."""
    return spark.createDataFrame(rows, schema)


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """A4: one row per day, ``start`` inclusive, ``end`` exclusive, column ``date_day``.

    The row count depends only on the two dates, never on the data.
    """
    s = F.lit(str(start)).cast("date")
    e = F.date_sub(F.lit(str(end)).cast("date"), 1)
    days = F.sequence(s, e, F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date_day"))
