"""Prefix trie of conversations: sorted sequences, longest common prefixes, range minima.

Conversations are sequences of turns. Sorted, all members of a prefix stand next to each other, so a
node of the trie is an interval of rows: a prefix of depth d starts where the common prefix with
the row before is shorter than d. Every such candidate finds its left and right extents on its own
by binary search over a sparse table of range minima of the common prefixes; there is no stack and no
order between nodes. What a node reports follows from its extents by differences of running sums, and
its smallest member by a range minimum.

The sorted rows are range-partitioned by (sequence, conv_id), so that equal conversations, however
many, are split over partitions, the *blocks*. A block resolves the nodes that lie inside it. Nodes
that reach its first or last row leave partial sums per block; a table of range minima over blocks
(one number a block, at most ``MAX_BLOCKS``) gives the block in which such a node starts, again by
binary search, and its parts are added up by a grouping. Ids of the members that end at a node which
spans blocks are hashed by a task that streams them in order and holds none.

A turn is 16 bytes of MD5 of its role and text; a task holds the digests of one block: about
``BLOCK_TURNS`` turns up to ``MAX_BLOCKS`` blocks, and at least one whole conversation.

Defined results: turns are ordered by turn, null first, ties by the MD5 of role and text; a null role
or text is empty; rows that repeat are turns of their own; rows of a null conv_id belong to no
conversation and are left out; an empty table has an empty result, otherwise there is a root. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripflow.llm.common import written

DIGEST = 16
BLOCK_TURNS = 1 << 14
MAX_BLOCKS = 1 << 14      # bounds what the driver and every task hold of all blocks
CHUNK = 256               # ids in a part of a list that spans blocks
EVERY, SHARED = 100, 6    # of the rebuilding rule
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- sequences -------------------------------------------------------------------------------------

def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, ids (hex digests of the turns in order) and chars (code points of their texts)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), digest.alias("id"),
                    F.length(text).cast("long").alias("chars"))
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).where("conv_id is not null")
    rows = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return rows.select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))


def rebuilt(convs: DataFrame, every: int = EVERY, shared: int = SHARED) -> DataFrame:
    """Conversations that begin with up to ``shared - 1`` turns of the first of their ``every``: the first
    h turns of conversation c - c % every (the remainder has the sign of c), then the own turns after
    the first h."""
    opener = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("opener"), *[F.slice(c, 1, shared - 1).alias(f"o_{c}") for c in ("ids", "chars")])
    h = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    both = convs.withColumn("opener", F.col("conv_id") - F.col("conv_id") % every).join(opener, "opener", "left")

    def mended(c: str) -> Column:
        first = F.coalesce(F.slice(f"o_{c}", 1, h), F.array().cast(dict(convs.dtypes)[c]))
        return F.concat(first, F.slice(c, h + 1, F.size(c)))
    return both.select("conv_id", mended("ids").alias("ids"), mended("chars").alias("chars"))


# --- extents by range minima -------------------------------------------------------------------------

class RangeMin:
    """Sparse table: minima of all runs of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [np.asarray(values)]
        while 2 << (len(self.levels) - 1) <= self.n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place to which all values behind ``at`` are at least ``least``."""
        place = np.array(at)
        for k in range(len(self.levels) - 1, -1, -1):
            far = place + (1 << k)
            ok = far < self.n
            ok[ok] = self.levels[k][place[ok] + 1] >= least[ok]
            place[ok] = far[ok]
        return place

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place behind which all values up to ``at`` are at least ``least``."""
        place = np.array(at)
        for k in range(len(self.levels) - 1, -1, -1):
            far = place - (1 << k)
            ok = far >= 0
            ok[ok] = self.levels[k][far[ok] + 1] >= least[ok]
            place[ok] = far[ok]
        return place

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum of each run, both ends included."""
        out = np.empty(len(first), self.levels[0].dtype)
        size = last - first + 1
        level = np.frexp(size.astype(float))[1] - 1
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.levels[k][first[own]], self.levels[k][last[own] - (1 << k) + 1])
        return out


def ramps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) for places 0 .. sizes[row] - 1 of each row."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def common_prefixes(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Common turns of each row and the one before; -1 for the first row."""
    both = np.minimum(size[1:], size[:-1])
    row, k = ramps(both)
    differ = (ids[start[1:][row] + k] != ids[start[:-1][row] + k]).any(1)
    out = both.copy()
    np.minimum.at(out, row[differ], k[differ])
    return np.concatenate([[-1], out])


def _counter(row_ok: np.ndarray, value: np.ndarray):
    """A function that counts the rows of [first, last] that are ok and have a value."""
    n = len(value)
    keys = np.sort(value[row_ok].astype(np.int64) * n + np.flatnonzero(row_ok))

    def count(v: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.searchsorted(keys, v * n + last, "right") - np.searchsorted(keys, v * n + first, "left")
    return count


# --- one block ------------------------------------------------------------------------------------------

NODE, PART, ENDS, EDGE = range(4)
_FIELDS = [
    ("kind", pa.int32()), ("block", pa.int32()), ("depth", pa.int64()), ("conv", pa.int64()), ("n", pa.int64()),
    ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("sha", pa.string()),
    # the parent: its conversation, or the part of this block that is its
    ("parent", pa.int64()), ("parent_low", pa.bool_()),
    # parts: whether they reach the first and the last row, and sums
    ("low", pa.bool_()), ("high", pa.bool_()), ("total", pa.int64()), ("fresh", pa.int64()), ("first_total", pa.int64()),
    ("before", pa.int64()), ("more", pa.bool_()),
    # lists of ids in pieces, and the edges of the block
    ("piece", pa.int64()), ("ids", pa.string()), ("first", pa.binary()), ("last", pa.binary()),
    ("sums", pa.list_(pa.int64())), ("inner", pa.int64())]
_SCHEMA = pa.schema(_FIELDS)
_SPARK = ", ".join(f"{n} {({'int32': 'int', 'int64': 'long', 'bool': 'boolean'}).get(str(t), 'array<long>' if n == 'sums' else str(t))}"
                   for n, t in _FIELDS)


def _rows(n: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                       for f in _SCHEMA], schema=_SCHEMA)


def block_nodes(block: int, conv: np.ndarray, keys: list[bytes], chars: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nodes inside one block of sorted conversations, the parts of those that reach beyond, and
    its edges. ``chars`` has the code points of all turns, row after row."""
    rows = len(conv)
    size = np.array([len(k) // DIGEST for k in keys], np.int64)
    start = np.cumsum(size) - size
    ids = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    running = np.concatenate([[0], np.cumsum(chars)])
    upto = lambda row, depth: running[start[row] + depth] - running[start[row]]
    every = np.arange(rows)
    shared = common_prefixes(ids, start, size)
    table, members = RangeMin(shared), RangeMin(conv)

    # candidates: each prefix at the row where it is new, the root at the first
    at, k = ramps(size - shared)
    depth = shared[at] + 1 + k
    low, high = table.left(at, depth), table.right(at, depth)
    total = upto(every, size)
    fresh = total - upto(every, np.maximum(shared, 0))
    fresh[0] = 0
    totals, news = (np.concatenate([[0], np.cumsum(x)]) for x in (total, fresh))
    leaf = np.concatenate([[0], np.cumsum(np.append(size[:-1] > shared[1:], False))])  # the last row's is open
    n = high - low + 1
    smallest = members.least(low, high)
    children = _counter(size > shared, shared)(depth, low + 1, high)
    more = size[low] > depth
    leaves = leaf[high + 1] - leaf[low]
    before = upto(low, np.maximum(depth - 1, 0))
    sum_total, sum_fresh = totals[high + 1] - totals[low], news[high + 1] - news[low + 1]
    ends = _counter(np.ones(rows, bool), size)(depth, low, high)

    inside = (low > 0) & (high < rows - 1)
    # the parent starts at or above the node's first row
    parent_low = np.where(depth > 0, table.left(low, depth - 1), 0)
    parent_high = np.where(depth > 0, table.right(low, depth - 1), rows - 1)
    known = inside & (parent_low > 0) & (parent_high < rows - 1)
    parent = members.least(parent_low, parent_high)
    sha = [None if not i else NO_ENDS if not e else
           hashlib.sha256(",".join(map(str, conv[a:a + e].tolist())).encode()).hexdigest()
           for i, a, e in zip(inside.tolist(), low.tolist(), ends.tolist(), strict=True)]
    saved = sum_total - n * before - sum_fresh - (total[low] - before)
    out = {"kind": np.where(inside, NODE, PART), "block": np.full(len(at), block), "depth": depth, "conv": smallest, "n": n,
           "children": children + np.where(inside, more, 0), "leaves": leaves, "sha": sha,
           "parent_low": parent_low == 0, "low": low == 0, "high": high == rows - 1,
           "total": sum_total, "fresh": sum_fresh, "first_total": total[low], "before": before, "more": more}
    for first in range(0, len(at), 10000):
        part = slice(first, first + 10000)
        yield _rows(len(at[part]), **{name: x[part] for name, x in out.items()},
                    saved=pa.array(saved[part], mask=~inside[part]), parent=pa.array(parent[part], mask=~known[part]))

    for j in np.flatnonzero(~inside & (ends > 0)).tolist():
        own = conv[low[j]:low[j] + ends[j]].tolist()
        pieces = [",".join(map(str, own[x:x + CHUNK])) for x in range(0, len(own), CHUNK)]
        m = len(pieces)
        yield _rows(m, kind=[ENDS] * m, block=[block] * m, depth=[int(depth[j])] * m, low=[bool(low[j] == 0)] * m,
                    high=[bool(high[j] == rows - 1)] * m, piece=range(m), ids=pieces)
    yield _rows(1, kind=[EDGE], block=[block], first=[keys[0]], last=[keys[-1]],
                sums=[upto(0, np.arange(size[0] + 1)).tolist()], inner=[int(shared[1:].min(initial=2 ** 62))])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        rows = pa.Table.from_batches(held)
        chars = rows.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        yield from block_nodes(TaskContext.get().partitionId(), rows.column("conv_id").to_numpy(),
                               rows.column("key").to_pylist(), chars.astype(np.int64))


# --- across blocks ----------------------------------------------------------------------------------------

def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, entered = [], []
        for a, b, sums in zip(*(batch.column(c).to_pylist() for c in ("last", "first", "sums")), strict=True):
            k = -1
            if a is not None:
                x, y = (np.frombuffer(v, np.uint64).reshape(-1, 2) for v in (a, b))
                m = min(len(x), len(y))
                differ = np.flatnonzero((x[:m] != y[:m]).any(1))
                k = int(differ[0]) if len(differ) else m
            shared.append(k)
            entered.append(sums[-1] - sums[max(k, 0)])
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(shared, pa.int64()), pa.array(entered, pa.int64()),
                                          batch.column("inner"), batch.column("size")],
                                         names=["block", "shared", "entered", "inner", "size"])


class Blocks:
    """What every task knows of all blocks: five numbers each."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("block")
        self.block, self.shared, self.entered, inner, self.size = (
            rows.column(c).to_numpy() for c in ("block", "shared", "entered", "inner", "size"))
        self.table = RangeMin(np.minimum(self.shared, inner))
        self.leaf = self.size > np.append(self.shared[1:], -1)    # whether the last row ends a leaf

    def place(self, block: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.block, block)

    def starts(self, j: np.ndarray, depth: np.ndarray, low: np.ndarray, high: np.ndarray):
        """(place of the block in which the node of each part starts, whether that is this part, and
        whether the node is one that ends in its first block)."""
        enters = low & (depth <= self.shared[j])
        first = np.where(enters, self.table.left(np.maximum(j - 1, 0), depth), j)
        return first, ~enters, low & ~high & ~enters


def _resolved(blocks, names: list[str]):
    """Parts or pieces of lists with the key of their node: (start, depth, head)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Blocks = blocks.value
        for batch in batches:
            col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            j, depth, low, high = b.place(col("block")), col("depth"), col("low").astype(bool), col("high").astype(bool)
            first, begins, head = b.starts(j, depth, low, high)
            keys = [pa.array(first, pa.int32()), pa.array(head, pa.bool_())]
            if "piece" in names:
                yield pa.RecordBatch.from_arrays([*keys, *[batch.column(c) for c in names]], names=["start", "head", *names])
                continue
            more = col("more").astype(bool)
            own = np.where(begins, col("first_total") - col("before"), b.entered[j])
            fresh = col("fresh") + own
            children = col("children") + (more & (begins | (b.shared[j] == depth)))
            leaves = col("leaves") + (high & b.leaf[j])
            made = {"fresh": fresh, "children": children, "leaves": leaves}
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(begins, pa.bool_()), *[pa.array(made[c], pa.int64()) if c in made else batch.column(c) for c in names]],
                names=["start", "head", "begins", *names])
    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list from its pieces, which come in order; no list is held."""
    key, sha = None, None
    row = lambda: pa.RecordBatch.from_arrays(
        [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([key[2]], pa.bool_()), pa.array([sha.hexdigest()])],
        names=["start", "depth", "head", "sha"])
    for batch in batches:
        for *now, ids in zip(*(batch.column(c).to_pylist() for c in ("start", "depth", "head", "ids")), strict=True):
            if now != key:
                if key is not None:
                    yield row()
                key, sha = now, hashlib.sha256(ids.encode())
            else:
                sha.update(("," + ids).encode())
    if key is not None:
        yield row()


def nodes(convs: DataFrame, blocks: int | None = None) -> DataFrame:
    """The trie of conversations (conv_id, ids, chars): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 of each node."""
    spark = convs.sparkSession
    rows = written(convs.select("conv_id", F.unhex(F.array_join("ids", "")).alias("key"), "chars"), "trie-rows")
    if blocks is None:
        turns = rows.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
        blocks = min(MAX_BLOCKS, 1 + turns // BLOCK_TURNS)
    ordered = rows.repartitionByRange(blocks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = written(ordered.mapInArrow(_blocks, _SPARK), "trie-blocks")

    edge = found.where(F.col("kind") == EDGE).select(
        "block", F.lag("last").over(W.orderBy("block")).alias("last"), "first", "sums", "inner",
        (F.length("last") / DIGEST).cast("long").alias("size"))
    known = spark.sparkContext.broadcast(Blocks(edge.mapInArrow(
        _edges, "block int, shared long, entered long, inner long, size long").toArrow()))

    own = ["block", "depth", "low", "conv", "n", "children", "leaves", "total", "fresh", "before", "parent_low"]
    key = ["start", "depth", "head"]
    parts = written(found.where(F.col("kind") == PART).select(*own, "high", "more", "first_total").mapInArrow(
        _resolved(known, own), "start int, head boolean, begins boolean, block int, depth long, low boolean, conv long, n long, "
                               "children long, leaves long, total long, fresh long, before long, parent_low boolean"), "trie-parts")
    pieces = found.where(F.col("kind") == ENDS).select("block", "depth", "low", "high", "piece", "ids").mapInArrow(
        _resolved(known, ["block", "depth", "piece", "ids"]),
        "start int, head boolean, block int, depth long, piece long, ids string")
    ends = pieces.repartition(*key).sortWithinPartitions(*key, "block", "piece").mapInArrow(
        _hashed, "start int, depth long, head boolean, sha string")
    begin = F.when(F.col("begins"), F.struct("block", "parent_low"))
    sums = parts.groupBy(*key).agg(
        F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "total", "fresh")],
        F.max("before").alias("before"), F.max(begin).alias("begin"))
    spans = written(sums.join(ends, key, "left").select(
        *key, "conv", "n", "children", "leaves", (F.col("total") - F.col("n") * F.col("before") - F.col("fresh")).alias("saved"),
        F.coalesce("sha", F.lit(NO_ENDS)).alias("sha"), F.col("begin.block").alias("block"), F.col("begin.parent_low").alias("parent_low")),
        "trie-spans")

    # the conversation of each part's node, for the nodes whose parent it is
    over = written(parts.join(spans.select(*key, F.col("conv").alias("of")), key).select(
        "block", (F.col("depth") + 1).alias("depth"), F.col("low").alias("parent_low"), "of"), "trie-over")
    shape = ["block", "depth", "conv", "n", "children", "leaves", "saved", "sha", "parent", "parent_low"]
    inner = found.where(F.col("kind") == NODE).select(*shape)
    every = inner.unionByName(spans.withColumn("parent", F.lit(None).cast("long")).select(*shape))
    return every.join(over, ["block", "depth", "parent_low"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce("parent", "of").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"))


def prefix_trie(turns: DataFrame, blocks: int | None = None) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    return nodes(rebuilt(written(sequences(turns), "conversations")), blocks)
