"""Malformed input: files that cannot be read and CSV rows that do not parse, as rows of a report.

A truncated or foreign file among the Parquet files of a feed fails a whole read, and a broken CSV
row would silently become a row of NULLs. Here both are found first, reported, and left out, so
that a build over the rest is complete.

Finding unreadable files costs one count per file from the footers, in parallel: no column is read.
Only files that yield no row are then opened one by one, to tell empty files from broken ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.files import plain
from tripflow.sources.readers import feed_files, read_feed
from tripflow.sources.schemas import ZONE_RAW

REPORT = "feed string, file string, record string, parsed string, reason string"
CORRUPT = "_corrupt_record"
UNREADABLE, UNPARSED = "unreadable file", "unparsed row"


def rows_per_file(spark: SparkSession, files: Sequence[str], schema: T.StructType) -> dict[str, int]:
    """Rows of each readable, non-empty file of ``files``, by plain path. Bounded by the files that are given."""
    if not files:
        return {}
    found = (spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*files)
             .groupBy(F.col("_metadata.file_path").alias("file")).count())
    return {plain(r.file): r["count"] for r in found.collect()}


def _opens(spark: SparkSession, file: str, schema: T.StructType) -> bool:
    try:
        spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(file).count()
    except (PySparkException, Py4JJavaError):
        return False
    return True


def split_readable(spark: SparkSession, files: Sequence[str], schema: T.StructType) -> tuple[dict[str, int], list[str]]:
    """(rows of each readable file, unreadable files). An empty file is readable and has 0 rows."""
    counted = rows_per_file(spark, files, schema)
    good, bad = {}, []
    for f in files:
        if plain(f) in counted:
            good[f] = counted[plain(f)]
        elif _opens(spark, f, schema):
            good[f] = 0
        else:
            bad.append(f)
    return good, bad


def read_sound_feed(spark: SparkSession, feed: str, paths: str | Sequence[str],
                    schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """A1 over the files that can be read, and the report of those that cannot."""
    good, bad = split_readable(spark, feed_files(spark, paths, schema), schema)
    rows = read_feed(spark, list(good), schema) if good else spark.createDataFrame([], schema)
    return rows, unreadable_report(spark, feed, bad)


def unreadable_report(spark: SparkSession, feed: str, files: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(feed, f, None, None, UNREADABLE) for f in files], REPORT)


def _zone_lines(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*ZONE_RAW.fields, T.StructField(CORRUPT, T.StringType())])
    # every field is parsed, whatever a query uses: a row counts as broken for any of them
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                          enforceSchema=True).select("*", F.col("_metadata.file_path").alias("file"))


def _broken() -> Column:
    """Condition on a line that reads all declared fields."""
    fields = F.to_json(F.struct(*[F.col(f.name) for f in ZONE_RAW.fields]))
    return F.col(CORRUPT).isNotNull() & fields.isNotNull()


def sound_zones(spark: SparkSession, path: str) -> DataFrame:
    """A2 without the rows that do not parse."""
    return _zone_lines(spark, path).where(~_broken()).select(*ZONE_RAW.fieldNames())


def zone_report(spark: SparkSession, path: str) -> DataFrame:
    """The zone rows that do not parse: file, text of the row, the fields that did parse, and reason."""
    parsed = F.to_json(F.struct(*[F.col(f.name) for f in ZONE_RAW.fields]))
    return _zone_lines(spark, path).where(_broken()).select(
        F.lit("zone").alias("feed"), "file", F.col(CORRUPT).alias("record"), parsed.alias("parsed"), F.lit(UNPARSED).alias("reason"))
