from __future__ import annotations

# Documents with every awkward case: nulls in any column, empty, spaces only, very long, repeated
# rows and copies, and columns whose names clash with those that the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, score double, "
          "words string, shard string, size long, `taken` string, data string, kind string")


def awkward(spark, extra=()):
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    texts = [(1, None), (2, ""), (3, "   \n\t "), (4, "one two three"), (5, "one two three"), (5, "one two three"),
             (None, "a text without an id that is long enough to hold some shingles"), (None, None),
             (6, long_text), (7, "x" * 200000), (8, "ünïcödé 😀 text ñandú " * 20), *extra]
    rows = [(d, t, None if k % 2 else "en", None if k % 3 == 0 else f"s{k % 4}", None, k, 0.5, "w", "s", 9, "t", "d", "k")
            for k, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, docs, label="quality"):
    rows = [(r.doc_id, k % 2) for k, r in enumerate(docs.select("doc_id").collect())] + [(None, 1), (4, None), (99999, 0)]
    return spark.createDataFrame(rows, f"doc_id long, {label} int")
