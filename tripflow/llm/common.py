"""Shared helpers: table access, scratch tables, text digests and guarded broadcasts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.files import Store
from tripflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One input table, read by Spark, projected to the named columns (all, if none is named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def file_rows(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """``table`` with ``row``: file and index in the file, which name a row in every read of the files."""
    row = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index"))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(row.alias("row"), *cols)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    This cuts the lineage and fixes row identity: a lost executor re-reads files that every
    executor can reach. The folder is ``spark.checkpoint.dir``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that no later plan reads any more."""
    for df in tables:
        store = Store(df.sparkSession)
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            store.delete(folder)


def utf8(col: str | Column) -> Column:
    """The UTF-8 bytes of a text; empty for null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def unit_hash(*cols: Column) -> Column:
    """A number in (0, 1), uniform and a function of the given texts alone (52 bits of MD5).

    The same expression exists in other SQL dialects, so results can be compared exactly.
    """
    return (hash52(*cols).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def hash52(*cols: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols)), 1, 13), 16, 10).cast("bigint")


def identity(doc_id: str | Column = "doc_id", text: str | Column = "text") -> list[Column]:
    """The texts that identify a document row: its id and the MD5 of its text, '' for null."""
    d = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    t = F.col(text) if isinstance(text, str) else text
    return [F.coalesce(d.cast("string"), F.lit("")), F.coalesce(F.md5(t), F.lit(""))]


def slices(batch: pa.RecordBatch, rows: int = 256):
    """Small slices of an Arrow batch, so that few Python objects exist at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
