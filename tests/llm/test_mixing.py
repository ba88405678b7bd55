from __future__ import annotations

import random
import re

from tripflow.llm import mixing
from .helpers import awkward, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = sum(w for s, w in weight.items() if s not in capped)
        level = (total - 3 * sum(sizes[s] for s in capped)) / open_ if open_ else 0
        over = {s for s in sizes if s not in capped and 3 * sizes[s] < weight[s] * level}
        if not over:
            return {s: 3 * sizes[s] if s in capped else weight[s] * level for s in sizes}
        capped |= over


def test_targets_copies_and_reruns(spark):
    r = random.Random(3)
    docs = [(i, " ".join("w" * r.randrange(1, 9) for _ in range(r.choice([1, 5, 40, 300]))), f"s{r.choice('aaaaaabcdef')}")
            for i in range(3000)] + [(5000 + i, "a b c\x0bd", None) for i in range(40)] + [(9000, "t i n y", "zz")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    want = targets(sizes)
    by_id = {i: (t, s) for i, t, s in docs}
    taken = {}
    for x in got:
        t, s = by_id[x.doc_id]
        assert (x.size, x.source_size) == (len(WORD.findall(t)), sizes[s])
        assert abs(x.target - want[s]) < 1e-6 * max(1, want[s])
        assert x.taken % x.size == 0 and 0 <= x.taken <= 3 * x.size
        taken[s] = taken.get(s, 0) + x.taken
    for s, w in want.items():
        assert abs(taken[s] - w) <= max(4, 0.01 * w), (s, taken[s], w)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted((x.doc_id, x.taken) for x in got) == sorted((x.doc_id, x.taken) for x in again)
    # the mix itself holds each document as often as it was taken
    copies = {r_.doc_id: r_.n for r_ in mixing.mixed(df).groupBy("doc_id").agg({"*": "count"}).withColumnRenamed(
        "count(1)", "n").collect()}
    assert copies == {x.doc_id: x.taken // x.size for x in got if x.taken}


def test_pareto_order_prefers_what_should_be_included(spark):
    # a source of which half is wanted: inclusion grows with size
    docs = spark.createDataFrame([(i, "w " * (10 if i % 2 else 30), "a") for i in range(4000)]
                                 + [(10000 + i, "w " * 20, "b") for i in range(1000)], "doc_id long, text string, source string")
    got = [x for x in mixing.mix(docs).collect() if x.source == "b"]
    assert 0 < sum(x.copies for x in got)
    a = [x for x in mixing.mix(docs, weights=(1, 3)).collect() if x.source == "a"]
    share = {s: sum(x.copies for x in a if x.size == s) / sum(x.size == s for x in a) for s in (10, 30)}
    assert share[30] > share[10] > 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(x.taken == 0 for x in got if x.size == 0)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(x.size, x.target, x.taken) for x in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_the_order_goes_on_while_a_document_fits(spark):
    # u is chosen so that the ranks are 1, 2, 3, ...; each long document fits no more, each short one does
    sizes = [5, 100, 4, 95, 3, 90, 2, 87, 2, 86, 2]
    odds = [(k + 1) * (n / 1000) / (1 - n / 1000) for k, n in enumerate(sizes)]
    rows = [("a", n, o / (1 + o)) for n, o in zip(sizes, odds)]
    df = spark.createDataFrame(rows, "source string, size long, u double")
    sources = spark.createDataFrame([("a", 100, 1e-3)], "source string, rest long, unit double")
    ranks = spark.createDataFrame([("a", n, 1e-3, u) for _, n, u in rows], "source string, size long, unit double, u double")
    taken = mixing.cuts(df, sources).select("taken").first().taken
    got, left = [], 100
    want = []
    for x in sorted(ranks.withColumn("rank", mixing.rank()).collect(), key=lambda x: x["rank"]):
        if x["size"] <= left:
            want.append(x["size"])
            left -= x["size"]
        if any(x["rank"] > t["after"] and x["size"] <= t["fits"] and x["rank"] <= t["upto"] for t in taken):
            got.append(x["size"])
    assert got == want == [5, 4, 3, 2, 2, 2]
