"""Whitening of embeddings: centred covariance, its leading components, and the projection on them.

Three passes over the vectors, each one scan whose tasks send numbers of a vector's size alone:
1. number of vectors and exact integer sums of each component;
2. the centred covariance, summed over tasks by (row, column) of its upper half;
3. the covariance of the whitened vectors, which measures the result.
The covariance matrix, of a vector's width squared whatever the number of vectors, goes to the
driver. There Householder reflections make it tridiagonal, Sturm counts bisect the leading
eigenvalues, and inverse iteration, orthogonalised within clusters, gives the components
(``eigen``). Components and means are broadcast, and a scan projects every vector. No vector is
shuffled or collected, so no group of equal vectors can be too large.

A component c of a vector becomes x = floor(64 * c) + 1000000. Sums of x are exact whole numbers;
x minus the whole part of its mean is exact, too, and the fraction is taken off as a double, so
the common offset costs no digits. The deviation of a vector is computed in whole numbers.

Defined results: a vector that is null, or that holds a null or non-finite entry, or one whose x
is beyond 2**52, takes no part and is not returned. The width is that of most vectors (of equals
the larger); vectors of another width take no part either, empty ones included. Directions without
variance (an eigenvalue up to 1e-12 of the largest) are no components: equal vectors, a single
vector and an empty table have an empty result. Repeated rows each count and are each returned. A
null id stays null. A deviation beyond a long is null. A width beyond ``MAX_WIDTH`` is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import written
from tripflow.llm.eigen import leading

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
MAX_WIDTH = 4096         # bounds what the driver holds: a square matrix of this width
NO_VARIANCE = 1e-12      # of the largest eigenvalue
EXACT = 2.0 ** 52
ROWS = 1024              # vectors that are worked on at a time


def whole(column: pa.Array, scale: int = SCALE, offset: int = OFFSET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, x) for each width: the places of the vectors of that width that take part, and
    their components as whole numbers, a row per vector."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    flat = column.flatten()
    holes = np.asarray(flat.is_null())
    flat = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), float)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(flat * scale)
        bad = holes | ~(np.abs(x) < EXACT - offset)
    for width in np.unique(sizes[sizes >= 0]):
        places = np.flatnonzero(sizes == width)
        at = starts[places][:, None] + np.arange(width)[None, :]
        places, at = places[~bad[at].any(1)], at[~bad[at].any(1)]
        if len(places):
            yield places, x[at].astype(np.int64) + offset


def of_width(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, x) of the vectors of one width, a bounded number at a time."""
    for first in range(0, batch.num_rows, ROWS):
        for places, x in whole(batch.column("embedding").slice(first, ROWS)):
            if x.shape[1] == width:
                yield places + first, x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            for places, x in whole(batch.column("embedding").slice(first, ROWS)):
                width = x.shape[1]
                n[width] = n.get(width, 0) + len(places)
                # as Python's whole numbers, which have no largest value
                total[width] = total.get(width, 0) + x.sum(0).astype(object)
    out = [(w, d, n[w], str(s)) for w in n for d, s in enumerate(total[w]) if w]
    out += [(w, -1, n[w], "0") for w in n]
    if out:
        w, d, k, s = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(d, pa.int32()), pa.array(k, pa.int64()),
                                          pa.array(s, pa.string())], names=["width", "dim", "n", "total"])


@dataclass(frozen=True)
class Centre:
    """Number of vectors, exact sums, and the mean as a whole part and a fraction."""
    n: int
    sums: tuple[int, ...]

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def fraction(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2, exact."""
        rest = np.array([s % self.n for s in self.sums], object)
        off = x - self.base
        most = (float(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * off.shape[1] < 2.0 ** 62:
            d = off * self.n - rest.astype(np.int64)
            return (d * d).sum(1).tolist()
        d = off.astype(object) * self.n - rest
        return [v if v < 1 << 63 else None for v in (d * d).sum(1)]


def centre(vectors: DataFrame) -> Centre | None:
    """Count and sums of the vectors of the most frequent width; None if no vector takes part."""
    parts = vectors.select("embedding").mapInArrow(_sums, "width int, dim int, n long, total string")
    per = written(parts.groupBy("width", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")), "whitening-sums")
    most = per.where("dim = -1").orderBy(F.desc("n"), F.desc("width")).select("width", "n").first()
    if most is None or not most.width:
        return None
    if most.width > MAX_WIDTH:
        raise ValueError(f"vectors of {most.width} components; at most {MAX_WIDTH} are supported")
    rows = per.where((F.col("width") == most.width) & (F.col("dim") >= 0)).select("dim", "total").collect()
    sums = dict((r.dim, int(r.total)) for r in rows)
    return Centre(most.n, tuple(sums[d] for d in range(most.width)))


def _gram(vectors: DataFrame, width: int, rows_of) -> np.ndarray:
    """Sum of y'y over all vectors, y = rows_of(x); each task sends the upper half of one matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = None
        for batch in batches:
            for _, x in of_width(batch, width):
                y = rows_of(x)
                g = y.T @ y if g is None else g + y.T @ y
        if g is not None:
            i, j = np.triu_indices(len(g))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(g[i, j])],
                                             names=["i", "j", "g"])
    found = vectors.select("embedding").mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(
        F.sum("g").alias("g")).toArrow()
    i, j, g = (found.column(c).to_numpy() for c in ("i", "j", "g"))
    size = int(i.max()) + 1 if len(i) else 0
    out = np.zeros((size, size))
    out[i, j] = g
    out[j, i] = g
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: apply it with ``project``."""
    centre: Centre
    values: np.ndarray          # eigenvalues, falling
    vectors: np.ndarray         # a unit eigenvector per row
    trace: float

    @property
    def projection(self) -> np.ndarray:
        return (self.vectors / np.sqrt(self.values)[:, None]).T


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``embedding`` on its leading components; None where there is no variance."""
    c = centre(vectors)
    if c is None:
        return None
    v = _gram(vectors, len(c.sums), c.centred) / c.n
    values, basis = leading(v, components)
    keep = values > NO_VARIANCE * values[0] if len(values) else np.zeros(0, bool)
    return Whitening(c, values[keep], basis[keep], float(np.trace(v))) if keep.any() else None


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    c, p = w.centre, w.projection
    # a column of ones beside the whitened components: its products are their sums
    moments = _gram(vectors, len(c.sums), lambda x: np.hstack([np.ones((len(x), 1)), c.centred(x) @ p])) / c.n
    mean = moments[0, 1:]
    return float(np.abs(moments[1:, 1:] - np.outer(mean, mean) - np.eye(len(mean))).max())


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def project(vectors: DataFrame, w: Whitening, error: float) -> DataFrame:
    """Each vector that takes part on each component."""
    sc = vectors.sparkSession.sparkContext
    shared = sc.broadcast((w.centre, w.projection, w.values / w.trace, error))  # of a vector's width only
    kind = dict(vectors.dtypes)["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, p, explained, off = shared.value
        k = len(explained)
        for batch in batches:
            for places, x in of_width(batch, len(c.sums)):
                m = len(places)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(np.repeat(places, k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, c.n)),
                     pa.array(c.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array((c.centred(x) @ p).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, off))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, {SCHEMA}")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every vector that
    takes part and every component."""
    w = fit(vectors, components)
    if w is None:
        kind = dict(vectors.dtypes)["vec_id"]
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    return project(vectors, w, identity_error(vectors, w))
