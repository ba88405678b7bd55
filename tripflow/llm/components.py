"""Connected components of links between nodes, by star contraction.

Large-star and small-star contraction alternate until the links are stars. Every join on a node
that may have very many links reads written tables on both sides, so that Spark can split it; each
round's tables replace those of the round before. Nothing but two counts a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import dropped, written


def _are_stars(links: DataFrame) -> bool:
    """Whether each node has one link, to a node that has none itself."""
    once = links.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return once and links.join(links.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node of its component.

    Links of a node to itself are left out, so a node without other links is not returned. Null
    nodes are no nodes. No links give no rows.
    """
    state = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "links")
    while not _are_stars(state):
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m")), "least")
        large = written(both.where("b > a").join(least, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large")
        dropped(state, least)
        least = written(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"), "least")
        small = large.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        state = written(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "links")
        dropped(large, least)
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
