"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Each source gets a target of words: its share by weight of all words, but at most ``max_copies``
times its own words; what a source cannot use is shared again among the others by weight. Of a
source that must be repeated, every document is first taken whole a certain number of times (the
whole part of target / source words). The fraction that is left is a fixed-size sample with
unequal probabilities: a document's inclusion probability ``p`` is proportional to its words, its
rank the random odds ``u / (1 - u)`` over the inclusion odds ``p / (1 - p)`` (Pareto order
sampling), and the documents of lowest rank are taken until the words left are used up. A document
that no longer fits is skipped and the order continues behind it, until no document behind fits.

``u`` is a hash of the document's id and text, so runs agree and no order of rows matters.

The order is cut without sorting a source: words are summed by (source, rank cell), the cell that
holds the cut is found from the running sums of the cells, and only that cell's documents are
ordered. Cells shrink as the table grows. The result of all this is a few numbers per source;
whether a document is taken then follows from its own row.

Defined results: a null text has size 0 and is never taken (0 words); a null source is a source
of its own and the last in order; documents that are equal in id and text share one rank and are
taken or left together; a null id hashes as an empty one; an empty table has an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripflow.llm.common import identity, unit_hash, written

# Fixed values of the mix: weights in the order of the sources, repeating, and what a word is
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"

CELL_ROWS = 1024          # documents of the largest source in one rank cell, on average
SMALL_SOURCES = 100_000    # up to so many sources, the table of sources is broadcast


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and the random number u of each document."""
    return docs.select("doc_id", *_measured())


def _measured() -> list[Column]:
    return [F.col("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            unit_hash(*identity()).alias("u")]


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, their 0-based order by code point, null last.

    Sources are range-partitioned and sorted by Spark; only the number of sources in each
    partition is summed up in order.
    """
    order = [F.col("source").isNull(), F.col("source")]
    parts = written(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = parts.groupBy("part").count().withColumn(
        "before", F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    at = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return parts.withColumn("at", at).join(F.broadcast(before), "part").withColumn(
        "place", F.coalesce("before", F.lit(0)) + F.col("at") - 1).drop("part", "count", "before", "at")


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: source, n, source_size, squares, target, whole, rest, unit.

    ``whole`` copies of every document are certain; ``rest`` words remain to be sampled, with
    inclusion probability ``unit * size``.
    """
    square = F.col("size").cast("decimal(38,0)") * F.col("size").cast("decimal(20,0)")
    sources = rows.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("size").alias("source_size"),
        F.sum(square.cast("decimal(38,0)")).cast("double").alias("squares"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = written(_ranked(sources).withColumn("weight", weight.cast("long")), "mix-weights")
    # the level: words per unit of weight, so that capped and other targets together are all words.
    # Raising it can only cap more sources, so the loop ends; it needs few rounds
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = (F.lit(max_copies) * F.col("source_size")).cast("double") < F.col("weight") * F.lit(level)
        s = placed.agg(F.count(F.when(over, 1)).alias("capped"),
                       F.sum(F.when(over, F.col("source_size"))).alias("used"),
                       F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if s.capped == capped or not s.open:
            break
        capped, level = s.capped, float(total - max_copies * (s.used or 0)) / float(s.open)
    full = (F.lit(max_copies) * F.col("source_size")).cast("double")
    target = F.when(full < F.col("weight") * F.lit(level), full).otherwise(F.col("weight") * F.lit(level))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (placed.withColumn("target", target)
            .withColumn("whole", F.floor(rate).cast("long"))
            .withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size"), 0).cast("long"))
            .withColumn("unit", F.when(F.col("squares") > 0, F.col("rest") / F.col("squares")).otherwise(0.0)))


def rank() -> Column:
    """Pareto rank: random odds over inclusion odds; least where inclusion is certain, infinite
    where nothing is to be sampled."""
    p = F.col("unit") * F.col("size")
    odds = F.col("u") / (F.lit(1.0) - F.col("u"))
    return (F.when(p <= 0.0, F.lit(float("inf"))).when(p >= 1.0, F.col("u") / F.lit(1e18))
            .otherwise(odds / (p / (F.lit(1.0) - p))))


def _cell(cells: int) -> Column:
    """Cell of a rank: even in rank / (1 + rank), where the cut of a source is never crowded."""
    q = F.col("rank")
    return F.least(F.floor(q / (q + 1.0) * cells), F.lit(cells - 1)).cast("long")


def cuts(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with ``taken``: what each round takes, as (after, fits, upto).

    A document is taken once more if in some round its rank lies beyond ``after``, its size is at
    most ``fits``, and its rank is at most ``upto``.
    """
    small = sources.count() <= SMALL_SOURCES
    hint = F.broadcast if small else (lambda x: x)
    most = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 1
    cells = max(256, math.ceil(most / CELL_ROWS))
    drawn = written(
        rows.withColumnRenamed("source", "s").join(hint(sources.where("rest > 0").select("source", "unit")),
                                                   F.col("s").eqNullSafe(F.col("source")))
        .where("size > 0").select("source", "size", rank().alias("rank")).withColumn("cell", _cell(cells)), "mix-ranks")
    state = sources.select("source", F.col("rest").alias("left"), F.lit(-1.0).alias("after"))
    taken = []
    while True:
        # every round skips one document at least of each source that is left, so the rounds end
        state = written(_prefix(drawn, state, hint), f"mix-round{len(taken)}")
        taken.append(state.select("source", F.struct("after", "fits", "upto").alias("taken")))
        state = state.where("skip is not null and left_after > 0").select(
            "source", F.col("left_after").alias("left"), F.col("skip").alias("after"))
        if state.isEmpty():
            break
    rounds_of = taken[0]
    for t in taken[1:]:
        rounds_of = rounds_of.unionByName(t)
    by_source = rounds_of.groupBy(F.col("source").alias("of")).agg(F.collect_list("taken").alias("taken"))
    return sources.join(hint(by_source), F.col("source").eqNullSafe(F.col("of")), "left").drop("of").withColumn(
        "taken", F.coalesce("taken", F.array().cast("array<struct<after:double,fits:bigint,upto:double>>")))


def _prefix(drawn: DataFrame, state: DataFrame, hint) -> DataFrame:
    """One round: for each source the longest prefix of its order that fits the words left.

    state: source, left, after. Adds fits (largest size that may be taken), upto (rank of the last
    document taken), left_after, and skip: the rank of the first document that did not fit.
    """
    s = state.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    open_ = drawn.join(hint(s), same).where("rank > after and size <= left")
    by_cell = open_.groupBy("of", "left", "cell").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(
        W.partitionBy("of").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # the first cell that does not fit whole; it need not exist
    cut = by_cell.withColumn("before", before).where("before + words > left").groupBy("of").agg(
        F.min(F.struct("cell", "before")).alias("c")).select(
        F.col("of").alias("cut_of"), F.col("c.cell").alias("cut_cell"), F.col("c.before").alias("before"))
    here = open_.join(hint(cut), F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("cell") == F.col("cut_cell")))
    # documents of equal rank are taken or left together
    ties = here.groupBy("of", "left", "before", "rank").agg(F.sum("size").alias("words"))
    run = F.col("before") + F.sum("words").over(W.partitionBy("of").orderBy("rank"))
    ends = ties.withColumn("run", run).groupBy("of").agg(
        F.max(F.when(F.col("run") <= F.col("left"), F.col("rank"))).alias("last"),
        F.max(F.when(F.col("run") <= F.col("left"), F.col("run"))).alias("used"),
        F.min(F.when(F.col("run") > F.col("left"), F.col("rank"))).alias("skip")).withColumnRenamed("of", "end_of")
    cells_upto = open_.join(hint(cut), F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("cell") < F.col("cut_cell")))
    tops = cells_upto.groupBy("of").agg(F.max("rank").alias("top")).withColumnRenamed("of", "top_of")
    return (s.join(hint(cut), F.col("of").eqNullSafe(F.col("cut_of")), "left")
            .join(hint(ends), F.col("of").eqNullSafe(F.col("end_of")), "left")
            .join(hint(tops), F.col("of").eqNullSafe(F.col("top_of")), "left")
            .select(F.col("of").alias("source"), "after", F.col("left").alias("fits"),
                    F.when(F.col("cut_cell").isNull(), F.lit(float("inf")))
                    .otherwise(F.coalesce("last", "top", "after")).alias("upto"),
                    (F.col("left") - F.coalesce("used", "before", F.lit(0))).alias("left_after"), "skip"))


def copies() -> Column:
    """How often a document is taken, from its rank and the numbers of its source."""
    sampled = F.exists("taken", lambda t: (F.col("rank") > t["after"]) & (F.col("size") <= t["fits"])
                       & (F.col("rank") <= t["upto"]))
    return F.when(F.col("size") > 0, F.col("whole") + F.when(sampled, 1).otherwise(0)).otherwise(0).cast("long")


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The written table of sources with targets and cuts, for the written result of :func:`sizes`."""
    return written(cuts(rows, written(targets(rows, weights, max_copies), "mix-targets")), "mix-plan")


def decide(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (with source, size and u) with the source's numbers and ``copies``."""
    table = sources.withColumnRenamed("source", "of").drop("n")
    if sources.count() <= SMALL_SOURCES:
        table = F.broadcast(table)
    return rows.join(table, F.col("source").eqNullSafe(F.col("of"))).withColumn("rank", rank()).withColumn(
        "copies", copies())


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken (words)."""
    rows = written(sizes(docs), "mix-sizes")
    return decide(rows, plan(rows, weights, max_copies)).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    The text does not travel: each row's copies follow from it and the small table of sources.
    """
    sources = plan(written(sizes(docs), "mix-sizes"), weights, max_copies)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(own, *_measured())
    return decide(rows, sources).where("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")

