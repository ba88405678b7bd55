from __future__ import annotations

import random
import zlib

import numpy as np

from tripflow.llm import quality, toxicity
from .helpers import awkward, empty, labels

SF = "/root/testdata/sf0.1"


def held_out(spark, scores, label):
    rows = scores.join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label), "doc_id").collect()
    folds = 4 if label == "toxic" else 5
    rest = 2 if label == "toxic" else 0
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == rest) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    return [(r.score, r[label], r.predicted) for r in rows if r.held_out]


def auc(pairs):
    order = sorted(pairs)
    ranks = [k for k, x in enumerate(order) if x[1] == 1]
    n, m = len(ranks), len(order) - len(ranks)
    return (sum(ranks) - n * (n - 1) / 2) / (n * m)


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = held_out(spark, quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")), "quality")
    assert auc(rows) > 0.98
    good = [p for _, y, p in rows if y == 1]
    bad = [p for _, y, p in rows if y == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = held_out(spark, toxicity.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")), "toxic")
    assert auc(rows) > 0.97
    assert np.mean([p for _, y, p in rows if y == 1]) > 0.88 and np.mean([p for _, y, p in rows if y == 0]) < 0.02


def test_pairs_of_the_machine_cost_linear_time_and_are_exact():
    m = quality.FactorisationMachine(20)
    rng = np.random.default_rng(0)
    m.w0, m.w, m.v = 0.3, rng.normal(size=20), rng.normal(size=(20, 4))
    idx, x = np.array([1, 4, 7, 19]), rng.random(4)
    pairs = sum(m.v[idx[i]] @ m.v[idx[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert abs(m.margin(idx, x) - (0.3 + m.w[idx] @ x + pairs)) < 1e-9


def test_machine_learns_an_interaction():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(1500):
        a, b = int(rng.integers(0, 2)), int(rng.integers(0, 2))
        rows.append((np.array([a, 2 + b]), np.ones(2), float(a == b)))   # no linear model can tell
    m = quality.FactorisationMachine(4, seed=3).fit(rows, epochs=30)
    assert all((m.score(i, x) > 0.5) == (y > 0.5) for i, x, y in rows)


def test_decoder_restores_hidden_words():
    r = random.Random(0)
    words = ["idiot", "stupid", "moron", "the", "and", "of", "reading", "is", "written", "house", "trash"]
    text = " ".join(r.choice(words) for _ in range(5000))
    counts = np.zeros(toxicity.TRIGRAMS, np.int64)
    c = np.concatenate([[0], toxicity.codes(text), [0]])
    np.add.at(counts, c[:-2] * toxicity.LETTERS ** 2 + c[1:-1] * toxicity.LETTERS + c[2:], 1)
    d = toxicity.Restorer(toxicity.LanguageModel(counts))
    for hidden, word in {"1d10t": "idiot", "i.d.i.o.t": "idiot", "i d i o t": "idiot", "iiidiooot": "idiot", "$tupid!": "stupid",
                         "STUP1D": "stupid", "m0r0n": "moron", "m_o_r_o_n": "moron", "tr@sh": "trash", "tr4$h": "trash",
                         "1 d 1 0 t": "idiot"}.items():
        assert d.restore(f"the {hidden} of") == f"the {word} of", hidden
    assert d.restore("The house, is (written).") == "the house is written"
    assert d.restore(None) == d.restore("") == d.restore(" .. ! ") == ""
    assert len(d.restore("a1" * 20000)) > 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    for op, label in ((quality, "quality"), (toxicity, "toxic")):
        got = op.classify(docs, labels(spark, docs, label)).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        none = spark.createDataFrame([], f"doc_id long, {label} int")
        assert len(op.classify(docs, none).collect()) == docs.count()
        assert op.classify(empty(spark), none).count() == 0
    assert quality.keep_good(docs, labels(spark, docs)).columns == docs.columns


def language(text):
    """A model of the letters of one text."""
    import pyarrow as pa
    out = next(toxicity._count(iter([pa.RecordBatch.from_pydict({"text": [text]})])))
    counts = np.zeros(toxicity.TRIGRAMS, np.int64)
    counts[out.column("gram").to_numpy()] = out.column("n").to_numpy()
    return toxicity.LanguageModel(counts)


ENGLISH = ("you are an idiot and an ass or a dumbass and so is that asshole who said shit to me as i hate him it is "
           "a book of the committee in which all good people stop and think of an answer that will do ") * 30


def test_probes_are_restored():
    r = toxicity.Restorer(language(ENGLISH))
    hidden = {"a$$": "ass", "@$$": "ass", "4$$": "ass", "@$$hole": "asshole", "dumba$$": "dumbass", "$#!t": "shit", "sh!t": "shit",
              "iddiioott": "idiot", "id io t": "idiot", "i  d  i  o  t": "idiot", "i\td\ti\to\tt": "idiot", "i d i o t": "idiot",
              "i.d.i.o.t": "idiot", "1d10t": "idiot", "idiooooot": "idiot", "h8": "hate", "ID10T!!": "idiot"}
    for written, word in hidden.items():
        assert r.restore(written) == word, written
        assert r.restore(f"you are {written} people") == f"you are {word} people", written
    # plain words, numbers and punctuation stay what they are
    for plain in ("it is a book", "stop and think", "all good people will stop"):
        assert r.restore(plain) == plain
    assert r.restore("Stop! (think) \"good\", people...") == "stop think good people"
    assert r.restore("455 2024 $5 3.14 $100 -- ... !!") == ""
    assert r.restore(None) == r.restore("") == r.restore(" \n\t ") == ""


def paths(r, token):
    """Every path through the lattice: (cost, letters)."""
    out = [(0.0, "")]
    for options in r.lattice(token):
        out = [(cost + extra, word if letters == " " and (not word or word[-1] == " ") else word + letters)
               for cost, word in out for letters, extra in options]
    found = []
    for extra, word in out:
        c = [0, 0, *[toxicity._letter(x) for x in word]]
        c += [0] if word and c[-1] else []
        found.append((extra + sum(float(r.cost[x, y, z]) for x, y, z in zip(c, c[1:], c[2:])), word))  # noqa: B905
    return found


def test_viterbi_is_the_best_of_all_paths():
    r = toxicity.Restorer(language(ENGLISH))
    rnd = random.Random(4)
    for _ in range(300):
        token = "".join(rnd.choice("aidots$@!1048#.+ -éж") for _ in range(rnd.randrange(1, 7)))
        every = paths(r, token)
        best = min(every)[0]
        assert r._decode(token) in {w.strip() for c, w in every if c <= best + 1e-6}, token


def test_other_scripts_are_counted_as_they_are_decoded():
    text = "привет мир καλημέρα 你好"
    assert [x for x in toxicity.codes(text) if x] == [toxicity._letter(c) for c in text if c != " "]


def test_training_rows_are_one_per_id_and_bounded_in_bytes(spark):
    from tripflow.llm.labelled import training_rows
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(40)] + [(7, f"copy {k}") for k in range(200)] + [(8, None), (None, "n")],
                                 "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 0), (3, None)], "doc_id long, quality int")
    rows = training_rows(docs, marks, "quality", 5, 0).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert len(ids) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(40))
    assert {r.doc_id: r.label for r in rows}.get(7, 0.5) == 0.5
    few = training_rows(docs, marks, "quality", 5, 0, size=1000).collect()
    assert 0 < sum(len(r.text or "") for r in few) <= 1000
    assert len(training_rows(docs, marks, "quality", 5, 0, rows=5).collect()) == 5


def plain_features(text):
    """The features, straight from their definition: {index: value}."""
    from collections import Counter
    from itertools import groupby
    words, lines = text.split(), text.split("\n")
    counts, weight = Counter(words), {}
    for w, c in counts.items():
        end = "" if w.isalpha() else w[len(w.rstrip("".join(x for x in set(w) if not (x.isalnum() or x == "_")))):]
        i = zlib.crc32(w[:len(w) - len(end)].lower().encode()) % (1 << quality.WORD_BITS)
        weight[i] = weight.get(i, 0) + c
        if end:
            i = (1 << quality.WORD_BITS) + zlib.crc32(end[:4].encode()) % (1 << quality.SHAPE_BITS)
            weight[i] = weight.get(i, 0) + c
    n, all_ = max(1, len(words)), "".join(words)
    solid, letters = max(1, len(all_)), sum(map(str.isalpha, all_))
    log = np.log2
    stats = [1 - letters / solid, sum(map(str.isupper, all_)) / max(1, letters), sum(map(str.isdigit, all_)) / solid,
             sum(not any(map(str.isalnum, w)) for w in words) / n, 1 - len(counts) / n, max(counts.values(), default=0) / n,
             min(1, max((len(list(g)) for _, g in groupby(words)), default=0) / 16), sum(a == b for a, b in zip(words, words[1:])) / n,  # noqa: B905
             1 - len(set(lines)) / len(lines), min(1, solid / n / 16), min(1, n / len(lines) / 128),
             len({w[-3:] for w in counts}) / max(1, len(counts)), min(1, log(1 + n) / 16), min(1, log(1 + max(1, len(text))) / 20),
             min(1, log(len(lines)) / 12)]
    out = {i: np.sqrt(c / n) for i, c in weight.items()}
    at = (1 << quality.WORD_BITS) + (1 << quality.SHAPE_BITS)
    for k, s in enumerate(stats):
        b = 1 + min(quality.BINS - 1, int(np.sqrt(s) * quality.BINS)) if s > 0 else 0
        out[at + k * (quality.BINS + 1) + b] = 1 / np.sqrt(len(stats))
    return out


def test_features_equal_their_definition():
    rnd = random.Random(9)
    texts = ["", " \n ", "a", "a a a a", "é!! é!! ...", "x\n\nx\n", "Word, word. word_ (word) 12 3,4", "é" * 5000 + " 😀 ñ!?"]
    texts += ["\n".join(" ".join("".join(rnd.choice("abAB1.,!_é") for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(8)))
                        for _ in range(rnd.randrange(1, 12))) for _ in range(80)]
    for t in texts:
        idx, val = quality.features(t)
        assert len(set(idx.tolist())) == len(idx)
        got, want = dict(zip(idx.tolist(), val.tolist(), strict=True)), plain_features(t)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got), t
    assert all((quality.features(None)[k] == quality.features("")[k]).all() for k in (0, 1))
