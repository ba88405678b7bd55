"""The corpus pipeline: from raw documents to shards of a deduplicated, clean, mixed corpus.

Each stage takes the documents that its predecessor kept and returns those that it keeps, with the
same columns; the last returns the shard of each document. Between two stages the documents are
written as Parquet and read again, so a lost executor costs one stage's tasks at most.

Defined results: a null text is judged as an empty one; texts without words are near copies of each
other, so one of them stays, and they hold no benchmark window; a text of white space has size 0 and
the mix does not take it; of copies and of rows that repeat the one of smallest doc_id stays, a null id
last; columns beyond those of ``documents`` are carried along whatever their names; an empty table
has an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import minhash, mixing, quality, sharding, wumanber
from tripflow.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of smallest doc_id."""
    return minhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return wumanber.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size and shard of each document of the mix."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("source mixing", mix_sources),
    ("sharding", shard),
]

# classification, consistent sampling and their training have no equivalent in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{k}")
    return docs
