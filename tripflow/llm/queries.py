"""The registered queries of the operators: thin calls over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import linededup, minhash, mixing, pii, quality, sharding, topk, toxicity, trie, urlfilter, warc, whitening, wumanber
from tripflow.llm.common import file_rows, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                             table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.spans(table(spark, sf_dir, "documents", "doc_id", "text")))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "labels", "doc_id", "quality"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wumanber.find_benchmark(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   table(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeats(file_rows(spark, sf_dir, "documents", "doc_id", "text"), named=True)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_warc, op2_toxicity, op3_minhash, op4_pii, op5_topk, op6_mixing,
                                   op7_quality, op8_decontamination, op9_linededup, op10_sharding,
                                   op11_trie, op12_urlfilter, op13_whitening)}


def oracles() -> dict[str, str]:
    from tripflow.llm import oracle
    return oracle.oracle_sql()
