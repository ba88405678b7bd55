from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tripflow.llm import suffixes as S
from tripflow.llm.common import written


def places(sequences):
    rows, at = [], 0
    for q in sequences:
        at += 3                                      # numbers may have gaps between sequences
        rows += [(at + k, at + len(q), c, -c) for k, c in enumerate(q)]
        at += len(q)
    return rows


def text_of(rows):
    by_pos = {p: (e, a) for p, e, a, _ in rows}
    return {p: tuple(by_pos[x][1] for x in range(p, e)) for p, (e, _) in by_pos.items()}


def common(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905


CASES = {
    "random": lambda r: [[r.randrange(3) for _ in range(r.randrange(1, 30))] for _ in range(12)],
    "one symbol": lambda r: [[7] * n for n in (1, 40, 40, 3)],
    "copies": lambda r: [[1, 2, 3, 4, 5, 6, 7, 8, 9]] * 30 + [[2, 3, 4], [9]],
    "period": lambda r: [[1, 2] * 25, [2, 1] * 20, [5]],
    "nothing common": lambda r: [list(range(10)), list(range(20, 25))],
}


def test_array_common_prefixes_and_earlier_matches(spark):
    for (name, make), block in zip(CASES.items(), (9, 11, 30, 12, 1000), strict=True):
        rows = places(make(random.Random(name)))
        texts = text_of(rows)
        df = spark.createDataFrame(rows, "pos long, end long, a long, b long").repartition(3)
        ranks = S.suffix_ranks(df, block)
        array = written(S.neighbours(df, ranks, block), "array")
        rows = sorted(array.collect(), key=lambda x: (x.part, x.local))
        order = [x.pos for x in rows]
        assert order == sorted(texts, key=lambda p: (texts[p], p)), name
        assert [x.lcp for x in rows] == [0] + [common(texts[p], texts[q]) for p, q in zip(order[1:], order)], name  # noqa: B905
        found = {x.pos: x.match for x in S.longest_earlier(array).collect()}
        assert found == {p: max((common(t, texts[q]) for q in texts if q < p), default=0) for p, t in texts.items()}, name


def test_some_places_only(spark):
    rows = places(CASES["random"](random.Random(5)))
    texts = text_of(rows)
    df = spark.createDataFrame(rows, "pos long, end long, a long, b long")
    some = df.where("pos % 3 = 0")
    found = {x.pos: x.match for x in S.longest_earlier(S.neighbours(some, S.suffix_ranks(df, 7), 7)).collect()}
    own = [p for p in texts if p % 3 == 0]
    assert found == {p: max((common(texts[p], texts[q]) for q in own if q < p), default=0) for p in own}


def test_empty(spark):
    df = spark.createDataFrame([], "pos long, end long, a long, b long")
    assert S.longest_earlier(S.neighbours(df, S.suffix_ranks(df))).count() == 0


def test_matches_in_blocks_equal_the_whole():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 60))
        pos = rng.permutation(n).astype(np.int64)
        lcp = rng.integers(0, 6, n).astype(np.int64)
        lcp[0] = 0
        low = lambda i, j: int(lcp[min(i, j) + 1:max(i, j) + 1].min())  # noqa: E731, B023
        want = [max((low(i, j) for j in range(n) if pos[j] < pos[i]), default=0) for i in range(n)]
        assert list(S.earlier_matches(pos, lcp)) == want
        cuts = sorted({0, n, *rng.integers(0, n, 4).tolist()})
        parts = [pa.table({"part": pa.array([a] * (b - a), pa.int32()), "local": pa.array(range(b - a)), "pos": pa.array(pos[a:b]),
                           "lcp": pa.array(lcp[a:b])}) for a, b in zip(cuts, cuts[1:])]  # noqa: B905
        out = pa.concat_tables([S._block_matches(p) for p in parts])
        known = S.handed_on(out)
        got = {}
        for r in out.to_pylist():
            if r["kind"] == S.ROW:
                best = r["match"]
                for (p, reach), far in zip(known[r["part"]], (r["left"], r["right"]), strict=True):
                    best = max([best, *[min(int(x), far) for q, x in zip(p, reach) if q < r["pos"]]])  # noqa: B905
                got[r["pos"]] = best
        assert [got[p] for p in pos.tolist()] == want
