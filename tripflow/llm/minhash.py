"""Near-duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

A document is a set of five-word shingles, each with weight TF x IDF. TF is how often the shingle
occurs; IDF is the mean of the inverse document frequencies of its words, counted over all
documents in a table of ``2**WORD_BITS`` hashed words. (A shingle's own document frequency would set copies
apart: the few shingles that an edit makes are the rarest of the corpus, so they would outweigh all that
a large group of copies shares, the more so the larger the corpus. Words that share an entry count as
one; that moves the logarithm of rare words alone.) ICWS draws, for each of ``BANDS * ROWS`` seeds, one shingle
and a level such that two documents draw the same with the probability of their weighted Jaccard
similarity. Documents that agree in all rows of a band are candidates, and candidates are verified
by their exact weighted Jaccard similarity. Linked documents form classes.

How the work is kept in bounds, whatever the groups:
- texts with equal words are one document (a class of copies) before anything else is done;
- a band's bucket emits no pairs of members: its members are compared with a few leaders of the
  bucket. Buckets of up to ``LEADERS + 1`` members are thereby compared in full. The first leader
  is compared first; the others only where they are still in another class;
- a larger bucket whose members are then still in several classes gets an exact rest: a search of
  these members by prefix filter. In the order of rarity, all that two texts share is at or behind the
  first shingle that they share. So texts of weights A and B have similarity t only if both have
  t / (1 + t) of A + B at or behind it: they meet there, and nowhere else. Texts of a template that are not
  similar have parts of their own of that weight in front of it, and do not meet;
- leaders are found by a partial top-n, links are followed by star contraction, and every join
  on a key that may be hot reads written tables on both sides, so that Spark can split it.

Defined results: a null text is an empty one; texts without words are copies of each other, and
similar to nothing else; a text of fewer than five words is one shingle; a class is named by its
smallest doc_id (null only if all are null); rows that repeat are copies; an empty table has an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BinaryType, StructField, StructType

from tripflow.llm.common import dropped, slices, utf8, written
from tripflow.llm.components import components
from tripflow.llm.wordhash import digest, mixed, shingle_hashes, word_hashes

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 14, 4        # a pair of similarity 0.8 shares a band with probability 0.9994
LEADERS = 8                # of a bucket
WORD_BITS = 20             # entries of the table of document frequencies: 2**20
TABLE_BITS = 16            # entries of the table of random draws
RARE_BITS = 20             # entries of the table of rarity, which orders shingles and decides nothing
SLACK = 1e-6               # relative, for rounding: the prefix filter lets a little more pass
SEED = 7


# --- statistics of the corpus ------------------------------------------------------------------

def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    holds, seen = np.zeros(1 << WORD_BITS, np.int64), 0
    for batch in batches:
        for part in slices(batch):
            for data in part.column("data").to_pylist():
                at = word_hashes(data) >> np.uint64(64 - WORD_BITS)
                holds[np.unique(at)] += 1
                seen += 1
    at = np.flatnonzero(holds)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()),
                                      pa.array(np.append(holds[at], seen), pa.int64())], names=["word", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """IDF of each word hash: 1 + ln((1 + documents) / (1 + documents with the word))."""
    found = docs.select(utf8("text").alias("data")).mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")).toArrow()
    word, n = found.column("word").to_numpy(), found.column("n").to_numpy()
    holds = np.zeros(1 << WORD_BITS)
    holds[word[word >= 0]] = n[word >= 0]
    return (1 + np.log((1 + n[word < 0].sum()) / (1 + holds))).astype(np.float32)


def weighted_shingles(data: bytes | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The document's shingles in ascending order, and their TF x IDF weights."""
    words = word_hashes(data)
    size = min(SHINGLE, len(words))
    h = shingle_hashes(words, SHINGLE)
    if not size:
        return h, np.zeros(0, np.float32)
    of_word = idf[words >> np.uint64(64 - WORD_BITS)]
    mean = of_word[:len(h)].copy()
    for k in range(1, size):  # always in the same order, so that equal shingles weigh the same
        mean += of_word[k:len(h) + k]
    shingles, first, times = np.unique(h, return_index=True, return_counts=True)
    return shingles, (mean[first] / np.float32(size)) * times.astype(np.float32)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: sum of minima over sum of maxima."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64))
    return low / (total - low) if total else 0.0


# --- consistent weighted sampling ----------------------------------------------------------------

class Sampler:
    """ICWS with the random draws of a (shingle, seed) taken from a table by their hash."""

    CHUNK = 8192  # shingles that are drawn for at a time, so that long texts need little memory

    def __init__(self, samples: int = BANDS * ROWS):
        rng = np.random.default_rng(SEED)
        n = 1 << TABLE_BITS
        self.r = rng.gamma(2.0, 1.0, n).astype(np.float32)
        self.inverse_r = (1 / self.r).astype(np.float32)
        self.beta = rng.random(n, dtype=np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, n)).astype(np.float32)
        self.seeds = rng.integers(1, 1 << 62, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def draw(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One number per seed that stands for the shingle and the level drawn."""
        log_w = np.log(weights)
        best = np.full(len(self.seeds), np.inf, np.float32)
        out = np.zeros(len(self.seeds), np.uint64)
        every = np.arange(len(self.seeds))
        for at in range(0, len(shingles), self.CHUNK):
            h = shingles[at:at + self.CHUNK]
            entry = ((h[None, :] * self.seeds[:, None]) >> np.uint64(64 - TABLE_BITS)).astype(np.intp)
            r, beta = self.r[entry], self.beta[entry]
            level = np.floor(log_w[None, at:at + self.CHUNK] * self.inverse_r[entry] + beta)
            # ln a = ln c - r (t - beta) - r; the smallest wins, of equals the smaller shingle
            log_a = self.log_c[entry] - r * (level - beta + np.float32(1))
            j = log_a.argmin(1)
            low = log_a[every, j]
            won = low < best
            best[won] = low[won]
            out[won] = (mixed(h[j]) + level[every, j].astype(np.int64).astype(np.uint64))[won]
        return out

    def bands(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A key per band: of its number and the draws of its rows."""
        drawn = self.draw(shingles, weights).reshape(BANDS, ROWS)
        key = np.arange(1, BANDS + 1, dtype=np.uint64)
        for k in range(ROWS):
            key = mixed(key + drawn[:, k])
        return key.view(np.int64)


def _keys(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            ids, keys = [], []
            for part in slices(batch):
                for data in part.column("data").to_pylist():
                    shingles, weights = weighted_shingles(data, idf.value)
                    ids.append(digest(data))
                    keys.append(sampler.bands(shingles, weights) if len(shingles) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "words", "keys"])
    return run


# --- candidates, verification, classes -----------------------------------------------------------

def _texts(docs: DataFrame) -> DataFrame:
    """words (the digest) and data of each document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [digest(data) for part in slices(batch) for data in part.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column("data")], names=["words", "data"])
    return docs.select(utf8("text").alias("data")).mapInArrow(run, "words binary, data binary")


def bucketed(rows: DataFrame) -> DataFrame:
    """(words, key): the members of each bucket."""
    drawn = rows.groupBy("words").agg(F.first("keys").alias("keys"))
    return written(drawn.select("words", F.explode("keys").alias("key")), "near-members")


def candidates(members: DataFrame) -> DataFrame:
    """(a, b, place): a member and a leader of one of its buckets; place 1 is the first leader."""
    order = W.partitionBy("key").orderBy(F.xxhash64("words", "key"), "words")
    first = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= LEADERS)
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    leaders = written(first.join(shared, "key").select("key", F.col("words").alias("leader"), "place"), "near-leaders")
    pairs = members.join(leaders, "key").where("words <> leader")
    return written(pairs.select(F.least("words", "leader").alias("a"), F.greatest("words", "leader").alias("b"), "place")
                   .groupBy("a", "b").agg(F.min("place").alias("place")), "near-pairs")


def _verifier(idf, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = lru_cache(maxsize=128)(lambda data: weighted_shingles(data, idf.value))
        for batch in batches:
            keep = []
            for part in slices(batch, 64):
                for a, b in zip(part.column("data_a").to_pylist(), part.column("data_b").to_pylist(), strict=True):
                    keep.append(similarity(vector(a), vector(b)) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def verified(pairs: DataFrame, texts: DataFrame, idf, least: float = SIMILAR) -> DataFrame:
    """The pairs whose weighted Jaccard similarity is at least ``least``."""
    both = pairs.select("a", "b").join(texts.select(F.col("words").alias("a"), F.col("data").alias("data_a")), "a").join(
        texts.select(F.col("words").alias("b"), F.col("data").alias("data_b")), "b")
    return both.mapInArrow(_verifier(idf, least), "a binary, b binary")


def unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(words, root): the members of buckets that leaders do not compare in full and that hold several classes."""
    rooted = written(members.join(roots, F.col("words") == F.col("node"), "left").select(
        "words", "key", F.coalesce("root", "words").alias("root")), "near-rooted")
    keys = written(rooted.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
                   .where((F.col("n") > LEADERS + 1) & (F.col("low") != F.col("high"))).select("key"), "near-crowded")
    return rooted.join(keys, "key", "left_semi").select("words", "root").distinct()


def _rarity(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds = np.zeros(1 << RARE_BITS, np.int64)
        for batch in batches:
            for part in slices(batch):
                for data in part.column("data").to_pylist():
                    np.add.at(holds, weighted_shingles(data, idf.value)[0] >> np.uint64(64 - RARE_BITS), 1)
        at = np.flatnonzero(holds)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(holds[at], pa.int64())], names=["at", "n"])
    return run


def prefix(shingles: np.ndarray, weights: np.ndarray, holds: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Places of the rarest shingles, up to where less than ``least`` of the weight remains; the
    weight from each of them on; and the weight of all."""
    order = np.lexsort((shingles, holds[shingles >> np.uint64(64 - RARE_BITS)]))
    remains = np.cumsum(weights[order][::-1], dtype=np.float64)[::-1]   # from each place on
    total = float(remains[0]) if len(order) else 0.0
    n = int((remains >= least * (1 - SLACK) * total).sum())
    return order[:n], remains[:n], total


def _prefixes(idf, holds, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                row, found, behind, of = [], [], [], []
                for k, data in enumerate(part.column("data").to_pylist()):
                    shingles, weights = weighted_shingles(data, idf.value)
                    at, remains, total = prefix(shingles, weights, holds.value, least)
                    row.append(np.full(len(at), k))
                    found.append(shingles[at].view(np.int64))
                    behind.append(remains)
                    of.append(np.full(len(at), total))
                row = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), part.column("words").take(row), part.column("root").take(row),
                     pa.array(np.concatenate(of)), pa.array(np.concatenate(behind))],
                    names=["shingle", "words", "root", "total", "behind"])
    return run


def rest(members: DataFrame, roots: DataFrame, texts: DataFrame, idf, least: float = SIMILAR) -> DataFrame:
    """(a, b): pairs of unsettled members in different classes that may be similar. No similar pair is missing."""
    open_ = written(texts.join(unsettled(members, roots), "words"), "near-rest")
    counts = open_.select("data").mapInArrow(_rarity(idf), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    holds = np.zeros(1 << RARE_BITS, np.int64)
    holds[counts.column("at").to_numpy()] = counts.column("n").to_numpy()
    rows = written(open_.select("words", "root", "data").mapInArrow(
        _prefixes(idf, texts.sparkSession.sparkContext.broadcast(holds), least),
        "shingle long, words binary, root binary, total double, behind double"), "near-prefixes")
    shared = written(rows.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                     .where("low <> high").select("shingle"), "near-shared")
    rows = written(rows.join(shared, "shingle", "left_semi"), "near-meeting")
    side = lambda x: rows.select("shingle", *[F.col(c).alias(f"{x}_{c}") for c in rows.columns if c != "shingle"])
    # texts of weights A and B have similarity t if they share t / (1 + t) of A + B; all that they share
    # is at or behind the first shingle that they share, in the order of rarity
    t = least * (1 - SLACK)
    met = side("a").join(side("b"), "shingle").where(
        (F.col("a_words") < F.col("b_words")) & (F.col("a_root") != F.col("b_root"))
        & (F.least("a_behind", "b_behind") >= F.lit(t / (1 + t)) * (F.col("a_total") + F.col("b_total"))))
    return written(met.select(F.col("a_words").alias("a"), F.col("b_words").alias("b")).distinct(), "near-rest-pairs")


def more_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after further links."""
    links = written(links, "near-more")
    if links.isEmpty():
        return roots
    joined = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))
    dropped(links)
    return joined


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, words, class_words of each document row: documents of equal class_words are near copies."""
    sc = docs.sparkSession.sparkContext
    kind = dict(docs.dtypes)["doc_id"]
    idf = sc.broadcast(inverse_frequencies(docs))
    rows = written(docs.select("doc_id", utf8("text").alias("data")).mapInArrow(
        _keys(idf), f"doc_id {kind}, words binary, keys array<long>"), "near-rows")
    members = bucketed(rows)
    pairs = candidates(members)
    needed = pairs.select(F.explode(F.array("a", "b")).alias("words")).distinct()
    texts = written(_texts(docs).groupBy("words").agg(F.first("data").alias("data")).join(needed, "words"), "near-texts")
    roots = components(verified(pairs.where("place = 1"), texts, idf))
    more = pairs.where("place > 1")
    if not more.isEmpty():
        # the other leaders, where both are not yet in one class
        root = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        apart = more.join(root("a"), "a", "left").join(root("b"), "b", "left").where(
            F.coalesce("a_root", "a") != F.coalesce("b_root", "b"))
        roots = more_links(roots, verified(apart, texts, idf))
        roots = more_links(roots, verified(rest(members, roots, texts, idf), texts, idf))
    return rows.select("doc_id", "words").join(roots, F.col("words") == F.col("node"), "left").select(
        "doc_id", "words", F.coalesce("root", "words").alias("class_words"))


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, class_id (the smallest doc_id of its class) and class_size."""
    rows = written(classes(docs), "near-classes")
    sizes = written(rows.groupBy("class_words").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")),
                    "near-sizes")
    return rows.join(sizes, "class_words").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns: of each class the one of smallest doc_id."""
    rows = written(classes(docs), "near-classes")
    lead = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "words")
    kept = rows.groupBy("class_words").agg(F.min(lead).alias("lead")).select(F.col("lead.words").alias("kept_words"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [digest(data) for part in slices(batch) for data in part.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(ids, pa.binary())], names=["row", "words"])


    schema = StructType([StructField("row", docs.schema), StructField("words", BinaryType())])
    keyed = docs.select(own, utf8("text").alias("data")).mapInArrow(run, schema)
    # copies collapse before the shuffle; of equal texts the row of smallest doc_id is kept
    one = keyed.groupBy("words").agg(F.min_by("row", F.struct(F.col("row.doc_id").isNull().alias("none"),
                                                              F.col("row.doc_id").alias("doc_id"))).alias("row"))
    return one.join(kept, F.col("words") == F.col("kept_words"), "left_semi").select("row.*")
