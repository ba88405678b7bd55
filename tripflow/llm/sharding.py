"""Sharding by extendible hashing: buckets split on one more hash bit until each fits.

A document's key is a string of hash bits: first 52 bits of a hash of its id and text, then 52
bits of a hash of its position in the input, which matter only for rows that repeat. The
directory maps bit prefixes to shards, and a bucket splits on the next bit only where its bytes
exceed the limit.

The directory is built from byte sums of hash cells, not from documents: one shuffle sums the
bytes by cell, another rolls the cells up to all their shorter prefixes, and each cell takes the
shortest prefix that fits. Cells that alone exceed the limit are refined by more bits in further
rounds, which touch only their documents.

Defined results: a null text has 0 bytes; a document that alone exceeds the limit is a shard of
its own (``fits`` false), every other shard fits; rows that repeat spread over shards by their
position; an empty table has no shard; a null id counts as an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripflow.llm.common import hash52, identity, utf8, written

BITS = 52                 # of each of the two hashes
SHARD_BYTES = 1 << 20     # default byte limit of a shard; a deployment sets some hundred MB
SPARE_BITS = 3            # bits of the first cells beyond those that evenly spread bytes need
ROUND_BITS = 6            # bits that each refinement adds


def _bits(h: Column) -> Column:
    return F.lpad(F.bin(h), BITS, "0")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, bytes, identity and key of each document; the text stays behind."""
    return docs.select(
        "doc_id", *[c.alias(n) for c, n in zip(identity(), ("id1", "id2"), strict=True)], F.octet_length(utf8("text")).cast("long").alias("n_bytes"),
        F.concat(_bits(hash52(*identity())),
                 _bits(hash52(F.lit("row"), F.monotonically_increasing_id().cast("string")))).alias("key"))


def directory(rows: DataFrame, limit: int) -> tuple[DataFrame, list[int]]:
    """(cell, shard, shard_bytes) of all cells, and the widths in bits of the cells.

    ``rows`` is a written result of :func:`keyed` without documents beyond the limit. Exactly one
    listed cell is a prefix of a document's key.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, width = 0, min(BITS, math.ceil(math.log2(max(1, total / limit))) + SPARE_BITS)
    todo, parts, widths = rows, [], []
    while True:
        cells = written(todo.groupBy(F.substring("key", 1, width).alias("cell"))
                        .agg(F.sum("n_bytes").alias("bytes")), "shard-cells")
        prefixes = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(low), F.lit(width))).alias("depth")).select(
            "cell", "bytes", F.expr("substring(cell, 1, depth)").alias("shard"))
        sums = prefixes.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes")).where(F.col("shard_bytes") <= limit)
        fit = prefixes.join(sums, "shard").groupBy("cell").agg(
            F.min(F.struct(F.length("shard").alias("depth"), "shard", "shard_bytes")).alias("s"))
        parts.append(fit.select("cell", "s.shard", "s.shard_bytes"))
        widths.append(width)
        big = cells.where(F.col("bytes") > limit)
        if width >= 2 * BITS or big.isEmpty():
            break
        todo = todo.withColumn("cell", F.substring("key", 1, width)).join(big, "cell", "left_semi").drop("cell")
        low, width = width + 1, min(width + ROUND_BITS, 2 * BITS)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, widths


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """One row per document row: doc_id, n_bytes, shard, depth, shard_bytes, fits.

    ``shard`` is the bit prefix, or ``L`` and the whole key for a document beyond the limit.
    """
    return _placed(docs, limit).drop("id1", "id2")


def _placed(docs: DataFrame, limit: int) -> DataFrame:
    rows = written(keyed(docs), "shard-keys")
    small, large = rows.where(F.col("n_bytes") <= limit), rows.where(F.col("n_bytes") > limit)
    cells, widths = directory(small, limit)
    # a document has one cell of each width, and exactly one of them is in the directory
    at = F.explode(F.array(*[F.substring("key", 1, w) for w in widths]))
    placed = small.select("doc_id", "id1", "id2", "n_bytes", at.alias("cell")).join(cells, "cell").select(
        "doc_id", "id1", "id2", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", F.lit(True).alias("fits"))
    alone = large.select("doc_id", "id1", "id2", "n_bytes", F.concat(F.lit("L"), "key").alias("shard"),
                         F.lit(2 * BITS).alias("depth"), F.col("n_bytes").alias("shard_bytes"),
                         F.lit(False).alias("fits"))
    return placed.unionByName(alone)


def write_shards(docs: DataFrame, folder: str, limit: int = SHARD_BYTES) -> DataFrame:
    """Write the documents as Parquet, one folder ``shard=s<prefix>`` for each shard; the assignment.

    Documents are told apart by id and text. Rows that repeat in both are dealt to the places that
    they were assigned, in any order.
    """
    placed = written(_placed(docs, limit), "shards")
    at = lambda *order: F.row_number().over(W.partitionBy("id1", "id2").orderBy(*order))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    left = docs.select(own, *[c.alias(n) for c, n in zip(identity(), ("id1", "id2"), strict=True)])
    left = left.withColumn("at", at(F.monotonically_increasing_id()))
    right = placed.select("id1", "id2", "shard").withColumn("at", at("shard"))
    left.join(right, ["id1", "id2", "at"]).select(
        F.concat(F.lit("s"), "shard").alias("shard"), "own").write.partitionBy("shard").parquet(folder)
    return placed.drop("id1", "id2")
