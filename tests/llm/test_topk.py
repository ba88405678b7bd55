from __future__ import annotations

import math
import random

import numpy as np

from tripflow.llm import topk


def brute(rows, k=20, every=20):
    ok = [(r, i, [math.floor(64 * x) for x in v]) for r, (i, v) in enumerate(rows)
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for r, i, v in ok:
        if i % every:
            continue
        s = sorted((-sum(a * b for a, b in zip(v, w)), j) for q, j, w in ok if q != r)[:k]  # noqa: B905
        out += [(i, n + 1, j, -t) for n, (t, j) in enumerate(s)]
    return sorted(out)


def test_equals_brute_force(spark):
    r = random.Random(5)
    for dims, n in ((1, 30), (3, 90), (8, 300)):
        rows = [(i, [r.choice([-0.5, -0.25, 0.0, 0.1, 0.5, 1.0]) for _ in range(dims)]) for i in range(n)]
        rows += rows[:25] + [(20, None), (40, []), (60, [None] * dims), (80, [float("nan")] * dims),
                             (100, [float("inf")] * dims), (None, [1.0] * dims), (120, [1.0])]
        df = spark.createDataFrame([(*x, 1, 2) for x in rows], "vec_id long, embedding array<float>, row int, x int")
        got = topk.top_k(df, block=64, query_block=8).collect()
        assert sorted((q.query_id, q.rank, q.vec_id, q.score) for q in got) == brute(rows)


def test_threshold_stops_early_where_lists_are_skewed():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.05, (4000, 6))
    x[:100] += 5  # a few candidates far ahead of the rest
    x = np.floor(x * 64)
    reads: list[int] = []
    score, place = topk.search(x[:3], np.arange(3), x, np.arange(4000), 20, reads)
    assert sum(reads) < 3 * 4000 / 4
    full = x[:3] @ x.T
    for i in range(3):
        full[i, i] = -1e18
        assert list(score[i]) == sorted(full[i], reverse=True)[:20]


def test_large_numbers_are_exact():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 1, (60, 4)) * 1e15)
    score, place = topk.search(x[:4], np.arange(4), x, np.arange(60), 5)
    whole = [[int(a) for a in v] for v in x]
    for i in range(4):
        want = sorted((-sum(a * b for a, b in zip(whole[i], w, strict=True)), j) for j, w in enumerate(whole) if j != i)[:5]
        assert [(-int(s), int(p)) for s, p in zip(score[i], place[i], strict=True)] == want


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(0, 1, 1, 64 * 32 + 128 * 32)]
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 0")).count() == 0
