"""Suffix array of number sequences by distributed prefix doubling, and longest earlier matches.

The input is a table of places: ``pos`` (a long that orders all places), ``end`` (the pos behind the
place's sequence; the places of a sequence are consecutive) and ``a``, ``b`` (the symbol at the place, as
two longs). A suffix starts at each place and reaches up to its end.

* **Ranks.** A suffix's rank of level k is the number of suffixes that are smaller in their first 2^k
  symbols. A round sorts (rank of the place, rank of the place 2^k further) over range partitions, in
  which equal keys are split by place, so that a symbol that a third of all places share is no hot
  partition. Ranks inside a partition come from its task; what continues from one partition to the next
  is settled from one row per partition. Only suffixes that still tie and have not ended go on.
* **Suffix array and common prefixes.** Ordered by the last rank, neighbours are compared through their
  ranks of all levels: the highest level of equal ranks gives 2^k common symbols, and the places
  behind them are compared in the next round, until they differ.
* **Longest earlier matches.** Suffixes that share a prefix are an interval of the array in which all
  common prefixes are as long. The longest match of a suffix with an earlier place is the deepest
  interval around it that holds an earlier place. Inside a partition (a *block* of the array) it is
  found with a list of neighbours from which places are taken in falling order. For intervals that span
  blocks, a block hands on its steps: for each length of common prefix up to its edge the smallest
  place, as far as no smaller place has a longer one.

A task holds one block: about ``BLOCK`` places, up to ``MAX_BLOCKS`` blocks. The driver sees one row per
block and its steps, whose number per block is bounded by the longest common prefix, so by the length of
one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import dropped, written

BLOCK = 1 << 15
MAX_BLOCKS = 1 << 14
FAR = np.int64(1) << np.int64(62)        # longer than any common prefix


def blocks_for(rows: int, block: int) -> int:
    return int(max(1, min(MAX_BLOCKS, rows // block + 1)))


# --- ranks by sorting ------------------------------------------------------------------------------------

def _starts(new: np.ndarray) -> np.ndarray:
    """For each row the index of the last row at or before it that is new."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _indexed(keys: list[str], columns: list[str]):
    """Sorted rows with their index in the partition and where their runs of equal keys start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        n = rows.num_rows
        new = np.ones((len(keys), n), bool)
        for i, c in enumerate(keys):
            v = rows.column(c).to_numpy()
            new[i, 1:] = v[1:] != v[:-1]
        first, group = _starts(new.any(0)), _starts(new[0])
        size = np.bincount(first, minlength=n)[first]
        part = np.full(n, TaskContext.get().partitionId(), np.int32)
        out = pa.Table.from_arrays(
            [*rows.select(columns).columns, pa.array(part), pa.array(np.arange(n)), pa.array(first), pa.array(group), pa.array(size > 1)],
            names=[*columns, "part", "local", "first", "run", "tied"])
        yield from out.to_batches(max_chunksize=10000)
    return run


def ranked(df: DataFrame, keys: list[str], name: str, rows: int, block: int = BLOCK) -> DataFrame:
    """``df`` (longs alone, among them ``pos``) in the order of (keys, pos) as a written table with
    ``part`` and ``local`` (partition and index in it), ``at`` (index among all rows), ``first`` and ``run``
    (the index of the first row with equal keys, and with an equal first key) and ``tied``."""
    spark = df.sparkSession
    cols = df.columns
    ordered = df.repartitionByRange(blocks_for(rows, block), *keys, "pos").sortWithinPartitions(*keys, "pos")
    schema = ", ".join(f"{c} long" for c in cols) + ", part int, local long, first long, run long, tied boolean"
    local = written(ordered.mapInArrow(_indexed(keys, cols), schema), name)
    key = F.struct(*keys)
    ends = local.groupBy("part").agg(
        F.count("*").alias("n"), F.min_by(key, "local").alias("low"), F.max_by(key, "local").alias("high"),
        F.max("first").alias("last_first"), F.max("run").alias("last_run")).orderBy("part").collect()
    fixes, offset, before = [], 0, None
    for k, e in enumerate(ends):
        joins = before is not None and before["high"] == e.low
        same_run = before is not None and before["high"][0] == e.low[0]
        lead = before["first"] if joins else offset
        lead_run = before["run"] if same_run else offset
        goes_on = k + 1 < len(ends) and ends[k + 1].low == e.high
        fixes.append((e.part, offset, lead, lead_run, joins, e.last_first if goes_on else -1))
        before = {"high": e.high, "first": lead if e.last_first == 0 else offset + e.last_first,
                  "run": lead_run if e.last_run == 0 else offset + e.last_run}
        offset += e.n
    fix = spark.createDataFrame(fixes, "part int, offset long, lead long, lead_run long, joins boolean, open long")
    # one row per partition, MAX_BLOCKS at most
    both = local.join(F.broadcast(fix), "part")
    return both.select(
        *cols, "part", "local", (F.col("offset") + F.col("local")).alias("at"),
        F.when(F.col("first") == 0, F.col("lead")).otherwise(F.col("offset") + F.col("first")).alias("first"),
        F.when(F.col("run") == 0, F.col("lead_run")).otherwise(F.col("offset") + F.col("run")).alias("run"),
        (F.col("tied") | (F.col("joins") & (F.col("first") == 0)) | (F.col("first") == F.col("open"))).alias("tied"))


def suffix_ranks(places: DataFrame, block: int = BLOCK) -> DataFrame:
    """(pos, end, ranks): the ranks of each suffix, level by level, up to the one at which it differs
    from all others or has ended. Of two suffixes the one of smaller last rank is the smaller."""
    n = places.count()
    first = ranked(places.select("pos", "end", "a", "b"), ["a", "b"], "suffix-symbols", n, block)
    state = written(first.select("pos", "end", F.array("first").alias("ranks"), F.col("tied").alias("open")), "suffix-ranks")
    dropped(first)
    span = 1
    while True:
        active = state.where("open").select("pos", "end", F.element_at("ranks", -1).alias("rank"))
        n = active.count()
        if not n:
            return state.select("pos", "end", "ranks")
        further = state.select((F.col("pos") - span).alias("pos"), F.element_at("ranks", -1).alias("next"))
        keyed = active.join(further, "pos", "left").select(
            "pos", "end", "rank", F.when(F.col("pos") + span < F.col("end"), F.col("next")).otherwise(-1).alias("next"))
        new = ranked(keyed, ["rank", "next"], "suffix-round", n, block).select(
            "pos", (F.col("rank") + F.col("first") - F.col("run")).alias("now"), (F.col("tied") & (F.col("next") >= 0)).alias("more"))
        after = written(state.join(new, "pos", "left").select(
            "pos", "end", F.when(F.col("now").isNull(), F.col("ranks")).otherwise(F.concat("ranks", F.array("now"))).alias("ranks"),
            F.coalesce("more", F.lit(False)).alias("open")), "suffix-ranks")
        dropped(state, new)
        state, span = after, 2 * span


# --- common prefixes of neighbours --------------------------------------------------------------------------

def neighbours(suffixes: DataFrame, ranks: DataFrame, block: int = BLOCK) -> DataFrame:
    """The suffix array of some of the places (``suffixes``: pos): a written table (part, local, pos, lcp), lcp
    being the common symbols with the row before, 0 for the first."""
    rows = ranks.join(suffixes.select("pos"), "pos", "left_semi").select("pos", "end", F.element_at("ranks", -1).alias("rank"))
    rows = written(rows, "suffix-some")
    array = ranked(rows, ["rank"], "suffix-array", rows.count(), block).select("part", "local", "at", "pos")
    array, sorted_rows = written(array, "suffix-order"), array
    dropped(rows, sorted_rows)
    before = array.select((F.col("at") + 1).alias("at"), F.col("pos").alias("other"))
    pairs = array.join(before, "at")
    done, step = [], written(pairs.select("at", F.col("pos").alias("x"), F.col("other").alias("y"), F.lit(0).cast("long").alias("lcp")), "lcp-pairs")
    of = lambda side: ranks.select(F.col("pos").alias(side), F.col("end").alias(f"{side}_end"), F.col("ranks").alias(f"{side}_ranks"))
    while not step.isEmpty():
        # a place behind its sequence has no ranks: nothing more is common
        both = step.join(of("x"), "x", "left").join(of("y"), "y", "left")
        same = F.coalesce(F.size(F.filter(F.zip_with("x_ranks", "y_ranks", lambda p, q: p == q), lambda e: e)), F.lit(0))
        whole = F.coalesce(F.col("x_ranks") == F.col("y_ranks"), F.lit(False))      # both ended, alike
        gain = F.when(whole, F.col("x_end") - F.col("x")).when(same > 0, F.pow(F.lit(2), same - 1).cast("long")).otherwise(0)
        moved = written(both.select("at", (F.col("x") + gain).alias("x"), (F.col("y") + gain).alias("y"), (F.col("lcp") + gain).alias("lcp"),
                                    (~whole & (same > 1) & (F.col("x") + gain < F.col("x_end")) & (F.col("y") + gain < F.col("y_end"))).alias("on")),
                        "lcp-step")
        done.append(moved.where("not on").select("at", "lcp"))
        dropped(step)
        step = written(moved.where("on").drop("on"), "lcp-pairs")
    every = done[0] if done else step.select("at", "lcp")
    for d in done[1:]:
        every = every.unionByName(d)
    return array.join(every, "at", "left").select("part", "local", "pos", F.coalesce("lcp", F.lit(0)).alias("lcp"))


# --- longest earlier matches ---------------------------------------------------------------------------------

def earlier_matches(pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each row of one block the longest common prefix with a row of smaller pos, 0 if there is none."""
    n = len(pos)
    before, behind = list(range(-1, n - 1)), list(range(1, n + 1))
    shared = [0, *lcp[1:].tolist(), 0]       # with the row that now stands before
    out = [0] * n
    for i in np.argsort(-pos, kind="stable").tolist():
        a, b = before[i], behind[i]
        left, right = shared[i], shared[b]
        out[i] = left if left > right else right
        if b < n:
            before[b] = a
        if a >= 0:
            behind[a] = b
        shared[b] = left if left < right else right
    return np.array(out, np.int64)


def steps(reach: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(reach, pos) of the places that no smaller place of at least the same reach beats; pos falls
    with reach. ``reach`` must fall along the rows."""
    best = np.minimum.accumulate(pos)
    keep = np.flatnonzero((pos == best) & (reach > 0))
    keep = keep[np.append(reach[keep][1:] != reach[keep][:-1], True)] if len(keep) else keep
    return reach[keep], pos[keep]


_OUT = "part int, kind int, pos long, match long, left long, right long"
ROW, TO_RIGHT, TO_LEFT, BLOCK_ROW = range(4)


def _block_matches(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("local")
    part, pos, lcp = rows.column("part")[0].as_py(), rows.column("pos").to_numpy(), rows.column("lcp").to_numpy().copy()
    edge, lcp[0] = int(lcp[0]), FAR
    left = np.minimum.accumulate(lcp)                                     # common with all rows up to the first
    right = np.append(np.minimum.accumulate(lcp[:0:-1])[::-1], FAR)       # and up to the last
    own = earlier_matches(pos, lcp)
    r_reach, r_pos = steps(right[::-1], pos[::-1])
    l_reach, l_pos = steps(left, pos)
    count = (len(pos), len(r_pos), len(l_pos), 1)
    zeros = lambda n: np.zeros(n, np.int64)
    return pa.table({
        "part": pa.array(np.full(sum(count), part, np.int32)),
        "kind": pa.array(np.repeat(np.array([ROW, TO_RIGHT, TO_LEFT, BLOCK_ROW], np.int32), count)),
        "pos": pa.array(np.concatenate([pos, r_pos, l_pos, zeros(1)])),
        "match": pa.array(np.concatenate([own, r_reach, l_reach, [edge]])),
        "left": pa.array(np.concatenate([left, zeros(len(r_pos) + len(l_pos)), [left[-1]]])),
        "right": pa.array(np.concatenate([right, zeros(len(r_pos) + len(l_pos) + 1)]))})


def _clip(reach: np.ndarray, pos: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    reach = np.minimum(reach, most)
    order = np.lexsort((pos, -reach))
    return steps(reach[order], pos[order])


def handed_on(rows: pa.Table) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """part -> steps that come in over its left edge and over its right edge, as (pos rising, reach)."""
    kind, part, pos, match, inner = (rows.column(c).to_numpy() for c in ("kind", "part", "pos", "match", "left"))
    blocks = sorted(part[kind == BLOCK_ROW].tolist())
    if not blocks:
        return {}
    edge = dict(zip(part[kind == BLOCK_ROW].tolist(), match[kind == BLOCK_ROW].tolist(), strict=True))
    through = dict(zip(part[kind == BLOCK_ROW].tolist(), inner[kind == BLOCK_ROW].tolist(), strict=True))
    own = {}
    for way in (TO_RIGHT, TO_LEFT):
        at = np.flatnonzero(kind == way)
        at = at[np.argsort(part[at], kind="stable")]
        cuts = np.searchsorted(part[at], blocks)
        own[way] = {b: (match[s], pos[s]) for b, s in zip(blocks, np.split(at, cuts[1:]), strict=True)}
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    found: dict[int, list] = {b: [none, none] for b in blocks}
    for way, order, side in ((TO_RIGHT, blocks, 0), (TO_LEFT, blocks[::-1], 1)):
        come = none
        for b, following in zip(order, [*order[1:], None], strict=True):
            found[b][side] = (come[1][::-1], come[0][::-1])
            if following is None:
                break
            passed = _clip(*come, through[b])
            both = [np.concatenate(x) for x in zip(passed, own[way][b], strict=True)]
            come = _clip(*both, edge[following] if way == TO_RIGHT else edge[b])
    return found


def longest_earlier(array: DataFrame) -> DataFrame:
    """(pos, match) of the suffix array (part, local, pos, lcp): symbols that each suffix shares with the
    earlier place that shares most."""
    spark = array.sparkSession
    found = written(array.groupBy("part").applyInArrow(_block_matches, _OUT), "suffix-matches")
    known = spark.sparkContext.broadcast(handed_on(found.where(F.col("kind") != ROW).toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, pos, match, left, right = (batch.column(c).to_numpy() for c in ("part", "pos", "match", "left", "right"))
            best = match.copy()
            for b in np.unique(part):
                own = part == b
                for (p, reach), far in zip(known.value[b], (left, right), strict=True):
                    if len(p):
                        # among the steps of smaller pos, the one of largest pos reaches furthest
                        k = np.searchsorted(p, pos[own]) - 1
                        best[own] = np.maximum(best[own], np.where(k >= 0, np.minimum(reach[np.maximum(k, 0)], far[own]), 0))
            yield pa.RecordBatch.from_arrays([batch.column("pos"), pa.array(best)], names=["pos", "match"])
    return found.where(F.col("kind") == ROW).drop("kind").mapInArrow(run, "pos long, match long")
