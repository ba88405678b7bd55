from __future__ import annotations

import random

import numpy as np

from tripflow.llm import minhash as M
from tripflow.llm.wordhash import digest, word_hashes, shingle_hashes
from .helpers import awkward, empty


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7)))
    passage = [word() for _ in range(30)]
    docs = [[word() for _ in range(r.randrange(20, 200))] for _ in range(40)]
    docs += [d[:10] + passage + d[10:] for d in docs[:15]]
    for d in docs[:12]:
        for edits in (1, 2, 4, 8):
            c = list(d)
            for _ in range(edits):
                c[r.randrange(len(c))] = word()
            docs.append(c)
    base = [word() for _ in range(150)]
    docs += [[*base[:k], word(), *base[k + 1:]] for k in range(120)]   # a large group of near copies
    texts = [" ".join(d) for d in docs] + ["", " . ", None, "tiny text", "Tiny, text!"]
    return [(i, t) for i, t in enumerate(texts)] + [(900 + i, t.upper()) for i, t in enumerate(texts[:6])]


def brute(docs, idf):
    keys = {i: digest((t or "").encode()) for i, t in docs}
    vec = {keys[i]: M.weighted_shingles((t or "").encode(), idf) for i, t in docs}
    root = {k: k for k in vec}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = list(vec)
    for i, a in enumerate(names):
        for b in names[:i]:
            if M.similarity(vec[a], vec[b]) >= 0.8:
                root[find(a)] = find(b)
    cls = {}
    for i, _ in docs:
        cls.setdefault(find(keys[i]), []).append(i)
    return {i: min(m) for m in cls.values() for i in m}


def test_equals_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in M.near_classes(df).collect()}
    want = brute(docs, M.inverse_frequencies(df))
    assert got == want
    assert sorted(r.doc_id for r in M.keep_one(df).collect()) == sorted(set(want.values()))


def test_document_frequencies(spark):
    """Counted by hand, without hashing."""
    docs = corpus()
    got = M.inverse_frequencies(spark.createDataFrame(docs, "doc_id long, text string"))
    holds = {}
    for _, t in docs:
        for w in set("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()):
            holds[w] = holds.get(w, 0) + 1
    entry = {w: int(word_hashes(w.encode())[0] >> np.uint64(64 - M.WORD_BITS)) for w in holds}
    shared = {}
    for w, e in entry.items():
        shared.setdefault(e, []).append(w)
    for e, words in shared.items():
        if len(words) == 1:
            assert abs(got[e] - (1 + np.log((1 + len(docs)) / (1 + holds[words[0]])))) < 1e-5
    assert sum(len(w) == 1 for w in shared.values()) > 0.95 * len(holds)


def test_prefix_filter_loses_no_similar_pair():
    rng = np.random.default_rng(7)
    holds = np.zeros(1 << M.RARE_BITS, np.int64)
    pool = np.unique(rng.integers(0, 1 << 63, 260, dtype=np.uint64))
    vectors = []
    for _ in range(150):
        base = pool[:200] if rng.random() < 0.7 else pool[60:]
        h = np.sort(rng.choice(base, rng.integers(120, len(base)), replace=False))
        vectors.append((h, (1 + 3 * (h % np.uint64(997)).astype(np.float64) / 997).astype(np.float32)))
        np.add.at(holds, h >> np.uint64(64 - M.RARE_BITS), 1)
    t, found = 0.8, 0
    kept = [M.prefix(*v, holds, t) for v in vectors]
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if M.similarity(a, b) >= t:
                found += 1
                (pa_, ra, ta), (pb, rb, tb) = kept[i], kept[j]
                behind = dict(zip(b[0][pb].tolist(), rb.tolist(), strict=True))
                assert any(min(x, behind[s]) >= t / (1 + t) * (1 - M.SLACK) * (ta + tb)
                           for s, x in zip(a[0][pa_].tolist(), ra.tolist(), strict=True) if s in behind)
    assert found > 20


def test_weighted_jaccard_by_hand():
    idf = np.ones(1 << M.WORD_BITS, np.float32)
    a = M.weighted_shingles(b"a b c d e f a b c d e", idf)   # one shingle twice
    b = M.weighted_shingles(b"a b c d e f", idf)
    assert len(a[0]) == 6 and a[1].sum() == 7
    assert abs(M.similarity(a, b) - 2 / 7) < 1e-6
    assert M.similarity(M.weighted_shingles(b"x y", idf), M.weighted_shingles(b"X, y", idf)) == 1.0
    assert M.similarity(M.weighted_shingles(b"", idf), M.weighted_shingles(b"", idf)) == 0.0


def test_sampling_agrees_with_similarity():
    rng = np.random.default_rng(2)
    sampler = M.Sampler(3000)
    for shared in (100, 250, 320):
        h = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
        other = np.sort(np.concatenate([h[:shared], rng.integers(0, 1 << 63, 80, dtype=np.uint64)]))
        a, b = (h, rng.random(len(h), np.float32) + 1), (other, rng.random(len(other), np.float32) + 1)
        assert abs((sampler.draw(*a) == sampler.draw(*b)).mean() - M.similarity(a, b)) < 0.04


def test_long_texts_draw_the_same_in_pieces():
    h = np.arange(1, 40000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    w = np.ones(len(h), np.float32)
    h.sort()
    whole, parts = M.Sampler(8), M.Sampler(8)
    whole.CHUNK = 1 << 20
    assert (whole.draw(h, w) == parts.draw(h, w)).all()


def test_words_and_shingles():
    assert (word_hashes("A b, ünï".encode()) == word_hashes("a B ünï.".encode())).all()
    assert len(word_hashes(b"")) == len(word_hashes(b" ,. ")) == 0
    w = word_hashes(b"p q p q p q p")
    assert len(set(w.tolist())) == 2 and len(set(shingle_hashes(w, 5).tolist())) == 2


def test_components(spark):
    chain = [(bytes([k]), bytes([k + 1])) for k in range(1, 40)] + [(b"\xf0", b"\xf1"), (b"\xf1", b"\xf0"), (b"\xf5", b"\xf5")]
    got = {bytes(r.node): bytes(r.root) for r in M.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    assert got == {**{bytes([k]): b"\x01" for k in range(2, 41)}, b"\xf1": b"\xf0"}
    assert M.components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = M.near_classes(docs).collect()
    assert len(got) == docs.count()
    ids = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert ids[1] == ids[2] == ids[3] == 1 and ids[4] == ids[5] == 4 and ids[6] == 6
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 6, 7, 8]
    assert M.near_classes(empty(spark)).count() == 0 and M.keep_one(empty(spark)).count() == 0


def test_close_pairs_among_texts_that_share_a_template(spark):
    r = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "vwxyz"]
    words = lambda n: [r.choice(vocabulary) for _ in range(n)]
    template = words(200)
    own = [words(30) for _ in range(160)]
    own += [d[:8] + words(22) for d in own[:40]]   # close copies: the similarity of others is below 0.8
    docs = [(i, " ".join(template + d)) for i, d in enumerate(own)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, M.inverse_frequencies(df))
    assert [want[160 + i] for i in range(40)] == list(range(40)) and len(set(want.values())) == 160
    assert {x.doc_id: x.class_id for x in M.near_classes(df).collect()} == want
