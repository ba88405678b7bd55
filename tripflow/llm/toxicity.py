"""Toxicity of deobfuscated text: noisy-channel decoding, then a linear score of what it says.

Writers hide words: digits and symbols for letters (``1d10t``, ``a$$``), separators inside a word
(``i.d.i.o.t``, ``i d i o t``, ``id io t``), letters repeated (``idiooot``, ``iddiioott``). The channel model
lists what each written character may stand for: letters, nothing, or the end of a word, at a cost each;
together they are a lattice of letters. A character language model, trigrams counted over *all*
documents, weighs the paths, and Viterbi search takes the best. Words of letters only with at most one
doubled letter, which are nearly all, need no decoding. A token of digits alone is a number, and so is
one of digits beside one currency sign.

The restored text is scored by a logistic model on character n-grams (hashed, present or not).
N-grams are chosen by their likelihood ratio against ``labels.toxic`` on a bounded sample of
labelled rows (``labelled.TRAIN_ROWS``); those that mark label 1 are kept.

Memory is bounded: the language model is one table of fixed size, filled by a distributed count.

Defined results: a null text is scored as an empty one, which gets the score of a text without
any marked n-gram; labels that are null or of unknown ids are ignored; without any usable label of
both kinds every score is 0; an empty table has an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import slices, written
from tripflow.llm.labelled import TRAIN_ROWS, scored, training_rows

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3

# Fixed values of the channel: what a written digit or symbol may stand for
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "#": "h", "€": "e", "£": "l", "¡": "i",
}
# readings of more than one letter
SOUNDS_LIKE = {"8": ("ate",), "2": ("to",), "4": ("for",)}
SEPARATORS = frozenset(".-_*~^'`,:;/\\")
# Costs in nats: of reading a look-alike as a letter, of leaving out a separator or a repetition,
# of a separator that does end a word, and of a digit or symbol that does (it stands for itself)
READ_COST, SKIP_COST, SPLIT_COST, KEEP_COST = 1.0, 0.5, 4.0, 8.0
# of leaving out the second of two equal letters, a "#", a symbol at the edge of a token ("$" and "@",
# which are no punctuation, cost more, and all that stands with them), of a space between short pieces that
# does part words, and of one that does not
DOUBLE_COST, HASH_COST, EDGE_COST, LETTER_SIGN_COST, SPACE_COST, JOIN_COST = 2.5, 14.0, 0.5, 14.0, 0.0, 1.5
LETTER_SIGNS = "$@"

# Letters of the language model: word boundary 0, a-z 1..26, Latin-1 letters, any other letter
_CODE = np.zeros(0x180, np.int64)
_CODE[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CODE[0xDF:0xF7] = np.arange(27, 51)
_CODE[0xF8:0x100] = np.arange(51, 59)
_CODE[0x100:0x180] = 59
# further letters of the basic plane, Greek or Chinese say, are one letter of the model; others are none
_FURTHER = np.array([59 if c >= 0x180 and chr(c).isalpha() else 0 for c in range(0x10000)], np.int64)
_FURTHER[:0x180] = _CODE
_CODE = _FURTHER
LETTERS = 60
TRIGRAMS = LETTERS ** 3

GRAMS = (4, 5, 6)          # lengths of the n-grams that are scored
GRAM_BITS = 20
CHOSEN = 4096              # n-grams in the model, at most
LEAST_TOXIC = 3           # documents of label 1 that hold a chosen n-gram, at least
LEAST_RATIO = 16.0         # likelihood ratio (G squared) of an n-gram that is chosen
EPOCHS, RATE, L2 = 800, 1.0, 1e-5
TOXIC_WEIGHT = 3.0        # of a document of label 1 in the fit, against one of label 0

# three or more pieces of one or two characters; a letter three times, or two doubled letters
_SPACED = re.compile(r"(?<!\S)\S{1,2}(?:\s+\S{1,2}){2,15}(?!\S)")
_REPEAT = re.compile(r"([^\W\d_])\1(?:\1|.{0,14}([^\W\d_])\2)")
_SPACES = re.compile(r"\s+")
_THRICE = re.compile(r"(.)\1\1")
LONGEST = 48              # characters that are decoded together
_EDGE = "".join(map(chr, list(range(33, 48)) + list(range(58, 65)) + list(range(91, 97)) + list(range(123, 127)))) \
    + "«»“”„‘’…–—¿"
_STARTS = "".join(c for c in LOOKS_LIKE if not c.isdigit())
_PLAIN_EDGE = "".join(c for c in _EDGE if c not in LOOKS_LIKE)
_SIGNS = re.compile("[" + re.escape(LETTER_SIGNS) + "]")


def codes(text: str) -> np.ndarray:
    """Language-model letters of a lower-case text; runs of other characters are one boundary."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(c < len(_CODE), _CODE[np.minimum(c, len(_CODE) - 1)], 0)
    if len(out):
        out = out[np.concatenate([[True], (out[1:] != 0) | (out[:-1] != 0)])]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(TRIGRAMS, np.int64)
    for batch in batches:
        for part in slices(batch):
            for text in part.column("text").to_pylist():
                c = np.concatenate([[0], codes((text or "").lower()), [0]])
                if len(c) > 2:
                    total += np.bincount(c[:-2] * (LETTERS * LETTERS) + c[1:-1] * LETTERS + c[2:], minlength=TRIGRAMS)
    at = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"])


class LanguageModel:
    """Cost in nats of a letter after two others: trigrams, smoothed by bigrams and letters."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(LETTERS, LETTERS, LETTERS).astype(np.float64)
        bi, one = tri.sum(0), tri.sum((0, 1))
        p1 = (one + 0.5) / (one.sum() + 0.5 * LETTERS)
        p2 = (bi + 8 * p1) / (bi.sum(1, keepdims=True) + 8)
        p3 = (tri + 8 * p2[None]) / (tri.sum(2, keepdims=True) + 8)
        self.cost = (-np.log(p3)).astype(np.float32)


def language_model(docs: DataFrame) -> LanguageModel:
    """The model of the letters of all documents. What is gathered has at most TRIGRAMS rows."""
    grams = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "gram long, n long").groupBy(
        "gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(TRIGRAMS, np.int64)
    found = grams.toArrow()
    counts[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return LanguageModel(counts)


def _letter(c: str) -> int:
    return int(_CODE[ord(c)]) if ord(c) < len(_CODE) else 0


class Restorer:
    """Viterbi decoding of written tokens under a language model."""

    def __init__(self, model: LanguageModel):
        self.cost = model.cost
        self._short = lru_cache(maxsize=1 << 15)(self._decode)

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each written character, what it may stand for and at what cost: letters, '' for nothing,
        or ' ' for the end of a word."""
        out, run = [], 0
        inner = [k for k, c in enumerate(token) if c.isalnum()]
        low, high = (inner[0], inner[-1]) if inner else (len(token), -1)
        for k, c in enumerate(token):
            run = run + 1 if k and c == token[k - 1] else 0
            if c.isalpha():
                # of a letter written three times or more one or two are meant; of two one, at a higher cost
                if run >= 2:
                    out.append([("", 0.0)])
                elif run == 1:
                    out.append([(c, 0.0), ("", SKIP_COST if token[k + 1:k + 2] == c else DOUBLE_COST)])
                else:
                    out.append([(c, 0.0)])
                continue
            options = [(x, READ_COST) for x in LOOKS_LIKE.get(c, "")] + [(x, 2 * READ_COST) for x in SOUNDS_LIKE.get(c, ())]
            if c == " ":
                options.append(("", JOIN_COST))
            elif c == "#":
                options.append(("", HASH_COST))
            elif c in SEPARATORS:
                options.append(("", SKIP_COST))
            elif not low <= k <= high:
                side = token[:low] if k < low else token[high + 1:]
                options.append(("", LETTER_SIGN_COST if _SIGNS.search(side) else EDGE_COST))
            elif run:
                options.append(("", SKIP_COST if c not in LETTER_SIGNS else LETTER_SIGN_COST))
            options.append((" ", SPACE_COST if c == " " else SPLIT_COST if c in SEPARATORS
                            else LETTER_SIGN_COST if c in LETTER_SIGNS or c == "#" else KEEP_COST))
            out.append(options)
        return out

    def decode(self, token: str) -> str:
        """The best reading of a token; a long one is read in pieces, so that memory and time are bounded."""
        if len(token) <= LONGEST:
            return self._short(token)
        return "".join(self._short(token[k:k + LONGEST]) for k in range(0, len(token), LONGEST))

    def _decode(self, token: str) -> str:
        """The best path through the lattice."""
        cost = self.cost
        # state: the last two letters; value: cost so far and the letters, as a linked list
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in self.lattice(token):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (so_far, path) in states.items():
                for letters, extra in options:
                    u, v, total, way = a, b, so_far + extra, path
                    if letters and not (letters == " " and b == 0):
                        for c in letters:
                            x = _letter(c)
                            total += float(cost[u, v, x])
                            u, v, way = v, x, (way, c)
                    key = (u, v)
                    if key not in after or total < after[key][0]:
                        after[key] = (total, way)
            states = after
        _, path = min(((t + float(cost[a, b, 0]) if b else t, p) for (a, b), (t, p) in states.items()), key=lambda x: x[0])
        letters = []
        while path:
            path, c = path
            letters.append(c)
        return "".join(reversed(letters)).strip()

    def restore(self, text: str | None) -> str:
        """The lower-case text with its hidden words restored; edge punctuation goes."""
        if not text:
            return ""
        text = text.lower()
        decode = self.decode
        if _SPACED.search(text):
            text = _SPACED.sub(lambda m: decode(_SPACES.sub(" ", m[0])), text)
        out = []
        for w in text.split():
            if w.isalpha():
                out.append(decode(w) if _REPEAT.search(w) else w)
                continue
            core = w.strip(_EDGE)
            if core.isalpha() and not any(c in w for c in _STARTS):
                out.append(decode(core) if _REPEAT.search(core) else core)
            elif any(map(str.isalpha, core)):
                core = _with_signs(w, core)
                out.append(decode(core) if not core.isalpha() or _REPEAT.search(core) else core)
            elif 3 <= len(w) <= LONGEST and _SIGNS.search(w) and not _THRICE.search(w) and sum(map(str.isdigit, w)) < 2:
                out.append(decode(w.strip(_PLAIN_EDGE)))    # symbols alone, as ``@$$``
        return " ".join(out)


def _with_signs(token: str, core: str) -> str:
    """The core of a token with the symbols at its edges that may be letters: runs that hold a letter sign,
    or one single symbol in front. A symbol three times in a row is no letter."""
    at = token.find(core)
    head, tail = token[:at], token[at + len(core):]
    head = head[len(head.rstrip("".join(_STARTS))):]
    tail = tail[:len(tail) - len(tail.lstrip(LETTER_SIGNS + "+!"))]
    if not _SIGNS.search(head) or _THRICE.search(head):
        head = head if len(head) == 1 else ""
    if not _SIGNS.search(tail) or _THRICE.search(tail):
        tail = tail if tail == "+" else ""
    return head + core + tail


def gram_hashes(text: str) -> np.ndarray:
    """Hashes of all n-grams of a restored text with a boundary at both ends; may repeat."""
    c = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for n in GRAMS:
        if len(c) >= n:
            h = np.full(len(c) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ c[k:len(c) - n + 1 + k]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            out.append(h >> np.uint32(32 - GRAM_BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _restored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for batch in batches:
            out = []
            for part in slices(batch):
                out += [restorer.restore(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.string())], names=["label", "text"])
    return run


def _gram_counts(wanted):
    """For each n-gram that is wanted (all, if None): documents that hold it; at -1 all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds, seen = np.zeros(1 << GRAM_BITS, np.int32), 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    holds[np.unique(gram_hashes(text))] += 1
                    seen += 1
        at = np.nonzero(holds if wanted is None else holds * wanted.value)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()),
                                          pa.array(np.append(holds[at], seen), pa.int64())], names=["gram", "n"])
    return run


def _documents_with(texts: DataFrame, wanted=None, least: int = 1) -> tuple[np.ndarray, int]:
    """Documents that hold each n-gram, where at least ``least`` do, and the number of documents."""
    found = texts.select("text").mapInArrow(_gram_counts(wanted), "gram long, n long").groupBy("gram").agg(
        F.sum("n").alias("n")).where(f"n >= {least} or gram = -1").toArrow()
    gram, n = found.column("gram").to_numpy(), found.column("n").to_numpy()
    out = np.zeros(1 << GRAM_BITS, np.int64)
    out[gram[gram >= 0]] = n[gram >= 0]
    return out, int(n[gram < 0].sum())


def _chosen_of(chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = chosen.value
        for batch in batches:
            held = []
            for part in slices(batch):
                held += [present(text, place).astype("<i2").tobytes() for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(held, pa.binary())], names=["label", "held"])
    return run


def present(text: str, place: np.ndarray) -> np.ndarray:
    """Places in the model of the chosen n-grams that a restored text holds."""
    at = place[gram_hashes(text)]
    return np.unique(at[at >= 0])


def choose(toxic: np.ndarray, t_all: int, clean: np.ndarray, c_all: int, limit: int = CHOSEN,
           least: float = LEAST_RATIO) -> np.ndarray:
    """Place in the model of each hash (-1: not in it): the n-grams that best mark label 1.

    ``toxic`` and ``clean`` are the documents of either label that hold each n-gram, of ``t_all``
    and ``c_all``. An n-gram is chosen by its likelihood ratio, if it is twice as frequent in
    documents of label 1.
    """
    place = np.full(1 << GRAM_BITS, -1, np.int32)
    if not t_all or not c_all:
        return place
    t, c = toxic.astype(np.float64), clean.astype(np.float64)
    share = (t + c) / (t_all + c_all)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0)

    ratio = 2 * (part(t, t_all * share) + part(c, c_all * share)
                 + part(t_all - t, t_all * (1 - share)) + part(c_all - c, c_all * (1 - share)))
    grams = np.nonzero((t > 0) & (ratio >= least) & (t / t_all > 2 * c / c_all))[0]
    best = grams[np.lexsort((grams, -ratio[grams]))[:limit]]
    place[best] = np.arange(len(best))
    return place


def fit_logistic(rows: list[tuple[np.ndarray, float]], size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on the places that rows hold; full-batch Adagrad."""
    w, b = np.zeros(size), 0.0
    y = np.array([label for _, label in rows])
    if not rows or y.min() == y.max():
        return w, -30.0
    at = np.repeat(np.arange(len(rows)), [len(r) for r, _ in rows])
    idx = np.concatenate([r for r, _ in rows]).astype(np.int64)
    gw, gb, weight = np.full(size, 1e-8), 1e-8, np.where(y > 0.5, TOXIC_WEIGHT, 1.0)
    b = math.log(max(1e-6, y.mean()) / max(1e-6, 1 - y.mean()))
    for _ in range(EPOCHS):
        m = np.bincount(at, w[idx], len(rows)) + b
        g = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y) * weight
        dw = np.bincount(idx, g[at], size) / len(rows) + L2 * w
        db = g.mean()
        gw += dw * dw
        gb += db * db
        w -= RATE * dw / np.sqrt(gw)
        b -= RATE * db / math.sqrt(gb)
    return w, float(b)


class ToxicityModel:
    """All that scoring needs: the language model, the chosen n-grams, weights and bias."""

    def __init__(self, lm: LanguageModel, place: np.ndarray, weights: np.ndarray, bias: float):
        self.lm, self.place, self.weights, self.bias = lm, place, weights, bias

    def score(self, restorer: Restorer, text: str | None) -> float:
        m = self.weights[present(restorer.restore(text), self.place)].sum() + self.bias
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, m)))))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Language model of all documents, n-grams and weights of the sample outside the held-out fold."""
    spark = docs.sparkSession
    lm = language_model(docs)
    sample = training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, rows).select("label", "text")
    restored = written(sample.mapInArrow(_restored(spark.sparkContext.broadcast(lm)), "label double, text string"),
                       "toxic-sample")
    toxic, t_all = _documents_with(restored.where("label >= 0.5"), least=LEAST_TOXIC)
    clean, c_all = _documents_with(restored.where("label < 0.5"), spark.sparkContext.broadcast(toxic > 0))
    place = choose(toxic, t_all, clean, c_all)
    size = int(place.max()) + 1
    if not size:
        return ToxicityModel(lm, place, np.zeros(0), -30.0)
    held = restored.mapInArrow(_chosen_of(spark.sparkContext.broadcast(place)), "label double, held binary").collect()
    rows_ = sorted((bytes(r.held), float(r.label >= 0.5)) for r in held)
    weights, bias = fit_logistic([(np.frombuffer(h, "<i2"), y) for h, y in rows_], size)
    return ToxicityModel(lm, place, weights, bias)


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        restorer = Restorer(m.lm)
        for batch in batches:
            scores = []
            for part in slices(batch):
                scores += [m.score(restorer, text) for text in part.column("text").to_pylist()]
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
