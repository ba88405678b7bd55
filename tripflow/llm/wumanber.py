"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A text is the sequence of its words; a pattern is a window of consecutive benchmark words.
For each pattern length there is one search table: a *shift table* over blocks of words tells
how far the search position may jump, because no pattern can end earlier; where the shift is
zero, the *bucket* of patterns with that last block is looked up, filtered by the first block,
and each pattern left is compared word by word.

Defined results: a null text has no words; an item without words has no window; an item row
with a null id marks words but is not counted among the items; items with equal ids count
once; repeated document rows each get their own result; an empty table gives an empty result
(documents) or no hit (benchmark).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import slices, utf8

WINDOW = 10
# Bytes of benchmark text in one search table. A larger benchmark is searched in several tables, one
# after the other. A megabyte of text makes about 110 MB of tables (measured), which the driver and
# each Python worker hold; so this is about 220 MB, whatever the size of the benchmark.
TABLE_BYTES = 2 << 20

# Bytes that belong to a word: digits, letters, and everything beyond ASCII. Upper-case
# ASCII letters are lowered, all other bytes separate words.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))

RESULT = "doc_id {id}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def words_of(data: bytes | None) -> list[bytes]:
    """The words of UTF-8 bytes, ASCII lower-cased."""
    return data.translate(_FOLD).split() if data else []


class SearchTable:
    """Wu-Manber tables of patterns that all have ``length`` words."""

    def __init__(self, length: int, patterns: dict[tuple, frozenset]):
        self.length = length
        self.block = block = min(2, length)
        self.default = length - block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for words, items in patterns.items():
            for end in range(block, length + 1):
                key = words[end - block:end]
                far = length - end
                if far < self.shift.get(key, self.default):
                    self.shift[key] = far
            self.buckets.setdefault(words[-block:], []).append((words[:block], words, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, frozenset]]:
        """(start, items) of each occurrence, by position."""
        n, block, size, default = len(words), self.block, self.length, self.default
        shift, buckets = self.shift.get, self.buckets
        at = size
        while at <= n:
            key = tuple(words[at - block:at])
            jump = shift(key, default)
            if jump:
                at += jump
                continue
            start = at - size
            first = tuple(words[start:start + block])
            for head, pattern, items in buckets[key]:
                if head == first and tuple(words[start:at]) == pattern:
                    yield start, items
            at += 1


class Matcher:
    """Search tables of all pattern lengths of some benchmark items."""

    def __init__(self, rows: list[tuple[str | None, bytes]], window: int = WINDOW):
        patterns: dict[int, dict[tuple, set]] = {}
        for item, data in rows:
            words = words_of(data)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found = patterns.setdefault(size, {}).setdefault(tuple(words[i:i + size]), set())
                if item is not None:
                    found.add(item)
        self.tables = [SearchTable(size, {w: frozenset(i) for w, i in p.items()})
                       for size, p in sorted(patterns.items())]

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint hit spans in words, by position, and the ids of the items found."""
        spans, items = [], set()
        for t in self.tables:
            for start, found in t.search(words):
                spans.append((start, start + t.length))
                items |= found
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def items_digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _matchers(docs: DataFrame, benchmark: DataFrame, window: int, table_bytes: int) -> list:
    """One broadcast matcher for each part of the benchmark of about ``table_bytes``."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("data"))
    size = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    parts = max(1, math.ceil(size / table_bytes))
    sc = docs.sparkSession.sparkContext
    out = []
    for k in range(parts):
        part = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64("item", "data"), F.lit(parts)) == k)
        out.append(sc.broadcast(Matcher([(r.item, bytes(r.data)) for r in part.toLocalIterator()], window)))
    return out


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document row: its number of words, of words inside any occurrence of a
    benchmark window, of items found and a digest of their ids, and whether it is contaminated.

    One pass over the documents without a shuffle. Where the benchmark exceeds
    ``table_bytes``, each part is searched in a pass of its own and the spans are united by
    document.
    """
    matchers = _matchers(docs, benchmark, window, table_bytes)
    id_type = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", utf8("text").alias("data"))
    if len(matchers) == 1:
        return rows.mapInArrow(_scan(matchers[0]), RESULT.format(id=id_type))
    keyed = rows.select("doc_id", "data", F.sha2("data", 256).alias("key"))
    spans = "array<struct<a:int,b:int>>"
    schema = f"doc_id {id_type}, key string, n_words long, spans {spans}, items array<string>"
    parts = [keyed.mapInArrow(_spans(m), schema).withColumn("part", F.lit(k)) for k, m in enumerate(matchers)]
    united = parts[0]
    for p in parts[1:]:
        united = united.unionByName(p)
    # rows that repeat have equal results: they are counted here and repeated at the end
    grouped = united.groupBy("doc_id", "key").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.count(F.when(F.col("part") == 0, 1)).alias("copies"))
    hit = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], s["b"]).alias("end")),
        lambda acc: acc["n"].cast("long"))
    return (grouped.withColumn("n_hit", hit).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The documents, with all their columns, that hold no occurrence of a benchmark window."""
    for m in _matchers(docs, benchmark, window, table_bytes):
        docs = docs.mapInArrow(_keep_clean(m), docs.schema)
    return docs


def _scan(matcher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher.value.match
        for batch in batches:
            n_words, n_hit, n_items, digest = [], [], [], []
            for part in slices(batch):
                for data in part.column("data").to_pylist():
                    words = words_of(data)
                    spans, items = match(words)
                    n_words.append(len(words))
                    n_hit.append(sum(b - a for a, b in spans))
                    n_items.append(len(items))
                    digest.append(items_digest(items))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(n_items, pa.int64()), pa.array(digest, pa.string()),
                 pa.array([n > 0 for n in n_hit], pa.bool_())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return run


def _spans(matcher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher.value.match
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        for batch in batches:
            n_words, spans, items = [], [], []
            for part in slices(batch):
                for data in part.column("data").to_pylist():
                    words = words_of(data)
                    found, ids = match(words)
                    n_words.append(len(words))
                    spans.append([{"a": a, "b": b} for a, b in found])
                    items.append(sorted(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(n_words, pa.int64()),
                 pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "key", "n_words", "spans", "items"])
    return run


def _keep_clean(matcher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher.value.match
        for batch in batches:
            clean = []
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    clean.append(not match(words_of(text.encode() if text else None))[0])
            yield batch.filter(pa.array(clean, pa.bool_()))
    return run
