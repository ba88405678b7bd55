from __future__ import annotations

import sys

import corpus_pipeline as P
from tripflow.llm import quality, queries
from .test_minhash import brute as near_brute
from .test_wumanber import brute as leak_brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "near-duplicates", "benchmark decontamination",
                                        "source mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, steps[-1], SF).write.parquet(str(tmp_path / str(k)))
        steps.append(spark.read.parquet(str(tmp_path / str(k))))
    ids = [sorted(r.doc_id for r in s.select("doc_id").collect()) for s in steps]
    assert all(s.schema.names == docs.schema.names for s in steps[:-1])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = {r.doc_id: r.predicted for r in quality.classify(docs, labels).collect()}
    assert ids[1] == sorted(d for d, p in score.items() if p)
    from tripflow.llm import minhash
    pairs = lambda s: [(r.doc_id, r.text) for r in s.select("doc_id", "text").collect()]
    assert ids[2] == sorted(set(near_brute(pairs(steps[1]), minhash.inverse_frequencies(steps[1])).values()))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids[3] == sorted(x[0] for x in leak_brute(pairs(steps[2]), bench) if not x[-1])
    assert set(ids[4]) <= set(ids[3]) and ids[5] == ids[4]
    assert sorted(r.doc_id for r in P.run(spark, SF).collect()) == ids[5]


def test_queries_are_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert {"pipeline", *queries.registry()} <= names
    assert {n.split("_")[0] for n in queries.registry()} == {f"op{k}" for k in range(1, 14)}
    assert "tripflow.llm" in sys.modules


def test_oracles(spark):
    import oracle_compare as O
    con = O.duck(SF)
    for name in queries.oracles():
        assert O.compare(spark, SF, name, con)["match"], name


def test_awkward_rows_go_through_all_stages(spark, tmp_path):
    """Nulls, empty and very long texts, copies, repeated rows and clashing columns; and no rows at all."""
    from .helpers import awkward, empty, labels
    docs = awkward(spark, [(50 + k, f"plain words number {k} " * 30) for k in range(12)])
    for name, rows in (("some", docs), ("none", empty(spark))):
        d = tmp_path / name
        rows.write.parquet(str(d / "documents.parquet"))
        labels(spark, docs).write.parquet(str(d / "labels.parquet"))
        spark.createDataFrame([("a", "one two three"), ("b", None), (None, "x y")], "item_id string, text string").write.parquet(str(d / "benchmark.parquet"))
        stored = spark.read.parquet(str(d / "documents.parquet"))
        at = stored
        for k, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, at, str(d))
            assert k == len(P.STAGES) - 1 or out.schema.names == docs.schema.names
            out.write.parquet(str(d / str(k)))
            at = spark.read.schema(out.schema).parquet(str(d / str(k)))
            ids = [r.doc_id for r in at.select("doc_id").collect()]
            assert set(ids) <= {r.doc_id for r in stored.select("doc_id").collect()}
            if k == 1:
                assert len(ids) == len(set(ids))        # copies are gone
            if k == 2:
                assert 4 not in ids                     # it is an item of the benchmark
        assert name == "some" or not ids
