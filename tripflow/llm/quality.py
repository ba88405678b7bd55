"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector x: its words, hashed (share of the document, square-rooted, so that
they have unit length together); the shapes of what its words end in, hashed likewise; binned
structure statistics; and binned metadata of the text (its lengths). The machine scores

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

where the pairs cost linear time: half of (square of the sum minus sum of the squares) of v_i x_i,
for each of the few dimensions of v. It is fitted by stochastic gradient steps on a bounded sample
of labelled rows (``labelled.TRAIN_ROWS``) and scores whole texts of any number of documents in
one pass without a shuffle; the model is a broadcast of fixed size.

Defined results: a null text is scored as an empty one; labels that are null or of unknown ids are
ignored; without any usable label every score is 0.5; an empty table has an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import slices
from tripflow.llm.labelled import TRAIN_ROWS, scored, training_rows

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
WORD_BITS = 16             # hashed words
SHAPE_BITS = 8             # hashed word endings
BINS = 12                  # bins of each statistic
RANK = 8                   # dimensions of the interactions
EPOCHS, RATE, L2, SEED = 8, 0.08, 1e-5, 20240

_SHAPE_AT = 1 << WORD_BITS
_STAT_AT = _SHAPE_AT + (1 << SHAPE_BITS)
_ENDING = re.compile(r"\W+\Z")


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure statistics in [0, 1] and, last, the metadata."""
    n, size = max(1, len(words)), max(1, len(text))
    joined = "".join(words)
    letters = sum(map(str.isalpha, joined)) if joined else 0
    upper = sum(map(str.isupper, joined)) if joined else 0
    digits = sum(map(str.isdigit, joined)) if joined else 0
    solid = max(1, len(joined))
    lines = text.split("\n")
    line_counts = Counter(lines)
    alone = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    longest_run = max((sum(1 for _ in g) for _, g in groupby(words)), default=0)
    same_next = sum(map(str.__eq__, words, words[1:]))
    return [
        1 - letters / solid,                               # symbols and digits
        upper / max(1, letters),
        digits / solid,
        alone / n,                                         # words of symbols only
        1 - len(counts) / n,                               # repeated words
        max(counts.values(), default=0) / n,
        min(1.0, longest_run / 16),
        same_next / n,
        1 - len(line_counts) / len(lines),                 # repeated lines
        min(1.0, solid / n / 16),                          # length of a word
        min(1.0, n / len(lines) / 128),                    # words in a line
        len({w[-3:] for w in counts}) / max(1, len(counts)),
        min(1.0, math.log2(1 + n) / 16),                   # metadata: words, characters, lines
        min(1.0, math.log2(1 + size) / 20),
        min(1.0, math.log2(len(lines)) / 12),
    ]


STATS = 15
FEATURES = _STAT_AT + STATS * (BINS + 1)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (each once) and values of a document's vector."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    weight: dict[int, float] = {}
    mask, shape_mask = (1 << WORD_BITS) - 1, (1 << SHAPE_BITS) - 1
    endings: dict[str, int] = {}
    for w, c in counts.items():
        if not w.isalpha():
            end = _ENDING.search(w)
            if end:
                endings[end[0][:4]] = endings.get(end[0][:4], 0) + c
                w = w[:end.start()]
        i = zlib.crc32(w.lower().encode()) & mask
        weight[i] = weight.get(i, 0) + c
    n = max(1, len(words))
    for e, c in endings.items():
        i = _SHAPE_AT + (zlib.crc32(e.encode()) & shape_mask)
        weight[i] = weight.get(i, 0) + c
    idx = np.fromiter(weight.keys(), np.int64, len(weight))
    val = np.sqrt(np.fromiter(weight.values(), np.float64, len(weight)) / n)
    stats = np.array(statistics(text, words, counts))
    # a value of 0 has a bin of its own, the others are binned by their square root
    bins = np.where(stats > 0, 1 + np.minimum(BINS - 1, (np.sqrt(np.clip(stats, 0, 1)) * BINS).astype(np.int64)), 0)
    at = _STAT_AT + np.arange(STATS) * (BINS + 1) + bins
    return np.concatenate([idx, at]), np.concatenate([val, np.full(STATS, 1 / math.sqrt(STATS))])


class FactorisationMachine:
    """w0, w and v; ``margin`` is linear in the number of non-zero entries."""

    def __init__(self, size: int, rank: int = RANK, seed: int = SEED):
        self.w0 = 0.0
        self.w = np.zeros(size, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (size, rank)).astype(np.float32)

    def margin(self, idx: np.ndarray, val: np.ndarray) -> float:
        v = self.v[idx] * val[:, None]
        total = v.sum(0)
        return float(self.w0 + self.w[idx] @ val + 0.5 * (total @ total - (v * v).sum()))

    def score(self, idx: np.ndarray, val: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.margin(idx, val)))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS, rate: float = RATE,
            l2: float = L2, seed: int = SEED) -> FactorisationMachine:
        """Adagrad on the logistic loss; both classes weigh the same in total up to a factor of 4."""
        if not rows:
            return self
        rng = np.random.default_rng(seed)
        good = sum(y for *_, y in rows) / len(rows)
        rare = max(good, 1 - good) / max(1e-9, min(good, 1 - good))
        heavy = min(4.0, math.sqrt(rare)) if 0 < good < 1 else 1.0
        g0, gw, gv = 1e-8, np.full_like(self.w, 1e-8), np.full_like(self.v, 1e-8)
        if good in (0.0, 1.0):
            self.w0 = 3.0 if good else -3.0
            return self
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                idx, val, y = rows[k]
                v = self.v[idx]
                x = val[:, None]
                total = (v * x).sum(0)
                m = self.w0 + self.w[idx] @ val + 0.5 * (total @ total - ((v * x) ** 2).sum())
                g = (1 / (1 + math.exp(-max(-30.0, min(30.0, m)))) - y) * (heavy if (y < 0.5) == (good >= 0.5) else 1.0)
                dw = g * val + l2 * self.w[idx]
                dv = g * (x * total - v * x * x) + l2 * v
                g0 += g * g
                gw[idx] += dw * dw
                gv[idx] += dv * dv
                self.w0 -= rate * g / math.sqrt(g0)
                self.w[idx] -= rate * dw / np.sqrt(gw[idx])
                self.v[idx] -= rate * dv / np.sqrt(gv[idx])
        return self


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        idx, val = [], []
        for part in slices(batch):
            for text in part.column("text").to_pylist():
                i, x = features(text)
                idx.append(i.astype("<i4").tobytes())
                val.append(x.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], names=["label", "idx", "val"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> FactorisationMachine:
    """The machine for ``labels.quality``, fitted outside the held-out fold."""
    sample = training_rows(docs, labels, "quality", FOLDS, HELD_OUT, rows)
    found = sample.select("doc_id", "label", "text").select("label", "text").mapInArrow(
        _vectors, "label double, idx binary, val binary").collect()
    data = sorted((bytes(r.idx), bytes(r.val), r.label) for r in found)  # the order of rows must not matter
    return FactorisationMachine(FEATURES).fit(
        [(np.frombuffer(i, "<i4"), np.frombuffer(x, "<f4"), y) for i, x, y in data])


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        for batch in batches:
            scores = []
            for part in slices(batch):
                scores += [machine.score(*features(text)) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])
    return run


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each document row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    kind = dict(docs.dtypes)["doc_id"]
    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _scorer(model), f"doc_id {kind}, score double")
    return out.select(*scored("doc_id", FOLDS, HELD_OUT, THRESHOLD))


def _keeper(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        for batch in batches:
            keep = []
            for part in slices(batch):
                keep += [machine.score(*features(text)) >= threshold for text in part.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents, with all their columns, that score at least ``threshold``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    return docs.mapInArrow(_keeper(model, threshold), docs.schema)
