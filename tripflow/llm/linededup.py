"""Repeated runs of lines across documents: a suffix array over line-ID sequences.

A document is the sequence of its lines' IDs (128-bit digests). Lines that occur once in the corpus are
in no repeated run, so they part the documents into sequences of lines that do occur elsewhere; sequences
of less than ``MIN_WORDS`` words hold no run that counts and are left out. Over all sequences
distributed prefix doubling builds the suffix array (``suffixes``); the longest-common-prefix intervals
of its rows give for each line the longest run from it on that also starts earlier in the corpus. Runs of
at least ``MIN_WORDS`` words are deleted in full, so of a repeated run the first occurrence stays and later
copies go.

The corpus is ordered by doc_id (null last), then position in the input, then line.

How the work is kept in bounds: IDs are counted with partial sums, so a line that a third of all rows
share is one row per task; what is sorted is range-partitioned with places as the last key; texts are
moved once, to the lines that they lose, always by the same join, whatever the sizes. A document's
lines are together in one row, as its text is.

Rows are named by ``row``: file and index in the file (``common.file_rows``), which are the same in each
read, whatever executors come or go. Documents without such a name are written first.

Defined results: a null text has no lines and stays null; an empty text is one empty line; a run
that overlaps its own earlier copy (one line repeated many times) is deleted behind its first
line; rows that repeat are later copies of each other; a document may lose all its lines and then
has an empty text; an empty table has an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm import suffixes
from tripflow.llm.common import dropped, slices, written

MIN_WORDS = 50
PLACES = 40               # bits of a place's number inside a partition


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line IDs and numbers of words of each text, as lists."""
    for batch in batches:
        if not batch.num_rows:
            continue
        digests, words, ends = [], [], [0]
        for part in slices(batch):
            for data in part.column("data").to_pylist():
                lines = data.split(b"\n")
                digests += [hashlib.md5(x).digest() for x in lines]
                words += [len(x.split()) for x in lines]
                ends.append(len(words))
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        values = pa.StructArray.from_arrays(
            [pa.array(np.arange(len(words)) - np.repeat(ends[:-1], np.diff(ends)), pa.int32()), pa.array(words, pa.int32()),
             pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1]))],
            names=["at", "words", "a", "b"])
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                                         names=["row", "doc_id", "lines"])


def runs_of(at: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines ``at`` (rising) of one document: those in runs of neighbouring lines with at least
    ``min_words`` words, the index behind their run, and how many lines from each on have ``min_words`` words
    (0 if the run has fewer from there)."""
    n = len(at)
    start = np.append(0, np.flatnonzero(np.diff(at) != 1) + 1)
    stop = np.append(start[1:], n)
    total = np.concatenate([[0], np.cumsum(words)])
    end = np.repeat(stop, stop - start)
    keep = np.repeat(total[stop] - total[start] >= min_words, stop - start)
    reached = np.maximum(np.searchsorted(total, total[:-1] + min_words), np.arange(n) + 1)
    need = np.where(reached <= end, reached - np.arange(n), 0)
    return np.flatnonzero(keep), end, need


def _places(min_words: int):
    """Documents in the order of the corpus -> their places, numbered in that order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << PLACES, 0
        for batch in batches:
            for part in slices(batch):
                held = []
                flat, ends = part.column("lines").flatten(), np.asarray(part.column("lines").offsets)
                at, words, a, b = (flat.field(k).to_numpy() for k in range(4))
                for k, (i, j) in enumerate(zip((ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist(), strict=True)):
                    keep, end, need = runs_of(at[i:j], words[i:j], min_words)
                    if len(keep):
                        # places of a run are consecutive, and so are the indexes of its lines
                        number = base + made
                        made += j - i
                        held.append((np.full(len(keep), k), number + keep, number + end[keep], a[i:j][keep], b[i:j][keep],
                                     at[i:j][keep], need[keep]))
                if held:
                    row, pos, end, a_, b_, at_, need = (np.concatenate(x) for x in zip(*held, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row").take(pa.array(row)), pa.array(pos), pa.array(end), pa.array(a_), pa.array(b_),
                         pa.array(at_, pa.int32()), pa.array(need, pa.int32())],
                        names=["row", "pos", "end", "a", "b", "at", "need"])
    return run


def later_copies(rows: DataFrame, min_words: int = MIN_WORDS, block: int = suffixes.BLOCK) -> DataFrame:
    """(row, runs): for each row that loses lines, the (at, lines) of its later copies.

    ``rows`` has row, doc_id and text.
    """
    types = dict(rows.dtypes)
    texts = rows.where("text is not null").select("row", "doc_id", F.col("text").cast("binary").alias("data"))
    docs = written(texts.mapInArrow(_lines, f"row {types['row']}, doc_id {types['doc_id']}, "
                                            "lines array<struct<at:int,words:int,a:long,b:long>>"), "line-ids")
    lines = docs.select("row", "doc_id", F.explode("lines").alias("line")).select("row", "doc_id", "line.*")
    repeated = written(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"), "line-repeated")
    kept = lines.join(repeated, ["a", "b"], "left_semi").groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "words", "a", "b"))).alias("lines"))
    kept = written(kept, "line-kept")
    dropped(docs, repeated)
    n = kept.agg(F.sum(F.size("lines"))).first()[0] or 0
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")]
    places = written(kept.repartitionByRange(suffixes.blocks_for(n, block), *order).sortWithinPartitions(*order).mapInArrow(
        _places(min_words), f"row {types['row']}, pos long, end long, a long, b long, at int, need int"), "line-places")
    dropped(kept)
    ranks = suffixes.suffix_ranks(places, block)
    array = suffixes.neighbours(places.where("need > 0"), ranks, block)
    found = suffixes.longest_earlier(array)
    later = places.select("pos", "row", "at", "need").join(found, "pos").where("match >= need and need > 0")
    return later.groupBy("row").agg(F.collect_list(F.struct("at", F.col("match").cast("int").alias("lines"))).alias("runs"))


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, totals, dropped_, spans = [], [], [], []
        for part in slices(batch):
            for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist(), strict=True):
                lines = text.split("\n") if text is not None else []
                gone = np.zeros(len(lines) + 1, np.int64)
                for r in runs or []:
                    gone[r["at"]] += 1
                    gone[r["at"] + r["lines"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append(",".join(f"{a}-{b}" for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True)))
                texts.append("\n".join(x for x, g in zip(lines, gone, strict=True) if not g) if text is not None else None)
                totals.append(len(lines))
                dropped_.append(int(gone.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(dropped_, pa.int64()),
             pa.array(spans, pa.string()), pa.array(texts, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "runs", "text"])


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS, block: int = suffixes.BLOCK, named: bool = False) -> DataFrame:
    """Per document row: doc_id, n_lines, n_dropped, runs (deleted lines, ``from-to`` with the end
    exclusive) and the text that is left.

    ``named`` says that ``docs`` has a column ``row`` that names each row, the same in each read
    (``common.file_rows``); otherwise the documents are written first.
    """
    kind = dict(docs.dtypes)["doc_id"]
    text = F.col("text").cast("string").alias("text")
    rows = docs.select("row", "doc_id", text) if named else written(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text), "line-rows")
    runs = written(later_copies(rows, min_words, block), "line-runs")
    # the same plan at every size: each text is moved once, and nothing is broadcast
    return rows.join(runs.hint("merge"), "row", "left").select("doc_id", "text", "runs").mapInArrow(
        _drop, f"doc_id {kind}, n_lines long, n_dropped long, runs string, text string")
