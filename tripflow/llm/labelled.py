"""Bounded samples of labelled documents, and measures of a classifier on held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripflow.llm.common import written

TRAIN_ROWS = 16_384       # labelled documents that a classifier is fitted on, at most
TRAIN_BYTES = 256 << 20   # and bytes of their texts


def fold(folds: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int,
                  rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> DataFrame:
    """doc_id, text and label (double) of at most ``rows`` labelled documents outside fold ``held``, whose texts
    have at most ``size`` bytes together.

    The ids are those of lowest hash, so the sample does not depend on the order of rows. Labels
    of one id that disagree are averaged; null labels and ids are left out. Of documents with one id
    the text of lowest digest is taken, so a repeated id has no more weight than another. The sample of
    ids is broadcast: its size is bounded by ``rows``.
    """
    known = labels.select("doc_id", F.col(label).cast("double").alias("label")).where(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold(folds) != held))
    sample = known.groupBy("doc_id").agg(F.avg("label").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    digest = F.coalesce(F.md5(F.col("text").cast("string")), F.lit(""))
    texts = docs.select("doc_id", F.struct(F.col("text").cast("string").alias("text")).alias("t"), digest.alias("digest"))
    one = written(texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min_by("t", "digest").alias("t"), F.first("label").alias("label")).select("doc_id", "t.text", "label"), "labelled")
    # a window over the sample's ids and sizes alone
    upto = F.sum(F.octet_length(F.coalesce("text", F.lit("")))).over(W.orderBy(F.xxhash64("doc_id"), "doc_id"))
    within = one.select("doc_id", upto.alias("upto")).where(F.col("upto") <= size).select("doc_id")
    return one.join(F.broadcast(within), "doc_id")


def scored(doc_id: str, folds: int, held: int, threshold: float) -> list[Column]:
    """held_out, score and predicted from a ``score`` column."""
    return [F.col(doc_id), (fold(folds, doc_id) == held).alias("held_out"), F.col("score"),
            (F.col("score") >= threshold).cast("int").alias("predicted")]
