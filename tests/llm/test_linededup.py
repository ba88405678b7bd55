from __future__ import annotations

import random

from tripflow.llm import linededup
from .helpers import awkward, empty


def brute(docs, min_words):
    """Every window of enough words that occurred before is extended, with each of its earlier places, as
    far as both go on alike."""
    seen, out = {}, []
    for d, t in docs:
        lines, gone = t.split("\n") if t is not None else [], set()
        for i in range(len(lines)):
            words, j = 0, i
            while j < len(lines) and words < min_words:
                words += len(lines[j].split())
                j += 1
            if words >= min_words:
                places = seen.setdefault(tuple(lines[i:j]), [])
                for other, k in places:
                    n = j - i
                    while i + n < len(lines) and k + n < len(other) and lines[i + n] == other[k + n]:
                        n += 1
                    gone |= set(range(i, i + n))
                places.append((lines, i))
        out.append((d, len(lines), len(gone), None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def test_equals_brute_force(spark):
    for seed, min_words, block in ((1, 3, 60), (2, 7, linededup.suffixes.BLOCK), (3, 20, 200)):
        r = random.Random(seed)
        line = [" ".join("abc"[:r.randrange(0, 4)]) for _ in range(4)]
        docs = [(i, "\n".join(r.choice(line) for _ in range(r.randrange(0, 40)))) for i in range(60)]
        docs += [(100, None), (101, ""), (102, "a b c\n" * 50)]
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        got = sorted((r_.doc_id, r_.n_lines, r_.n_dropped, r_.text) for r_ in linededup.drop_repeats(df, min_words, block).collect())
        assert got == brute(docs, min_words)


def test_runs_are_maximal_and_the_first_copy_stays(spark):
    passage = "\n".join(f"line {k} of a passage with ten words in each one" for k in range(9))
    docs = [(2, f"own start\n{passage}\nown end"), (1, f"{passage}\nother"), (3, f"x\n{passage}")]
    got = {r.doc_id: r for r in linededup.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].n_dropped == 0 and got[2].runs == "1-10" and got[2].text == "own start\nown end" and got[3].text == "x"


def test_awkward_rows(spark):
    long_line = "a passage of more than fifty words " * 9
    docs = awkward(spark, [(20, long_line), (20, long_line), (21, "head\n" + long_line), (None, long_line)])
    got = linededup.drop_repeats(docs).collect()
    assert len(got) == docs.count()
    assert sorted(((r.doc_id, r.n_dropped) for r in got if r.n_dropped), key=str) == [(20, 1), (21, 1), (None, 1)]
    assert all(r.text is None and r.n_lines == 0 for r in got if r.doc_id == 1)
    assert linededup.drop_repeats(empty(spark)).count() == 0


def maximal(docs, min_words):
    """(doc_id, lines deleted): each line's longest match with an earlier place, extended in full."""
    suffixes, out = [], []
    for d, t in docs:
        lines, gone = t.split("\n"), set()
        for i in range(len(lines)):
            own = lines[i:]
            match = max((next((k for k, (x, y) in enumerate(zip(own, s)) if x != y), min(len(own), len(s)))
                         for s in suffixes), default=0)
            if sum(len(x.split()) for x in own[:match]) >= min_words:
                gone |= set(range(i, i + match))
            suffixes.append(own)
        out.append((d, sorted(gone)))
    return out


def deleted(spark, docs, *args):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return sorted((r.doc_id, [k for a in filter(None, r.runs.split(",")) for k in range(*map(int, a.split("-")))])
                  for r in linededup.drop_repeats(df, *args).collect())


def test_the_tail_of_a_run_goes_with_it(spark):
    line = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    for sizes in ((60, 10, 10, 15), (30, 30, 5)):
        run = "\n".join(line(f"s{i}w", n) for i, n in enumerate(sizes))
        docs = [(1, f"own one\n{run}\nend one"), (2, f"own two\n{run}\nend two")]
        assert deleted(spark, docs) == [(1, []), (2, list(range(1, len(sizes) + 1)))]


def test_equals_maximal_matches(spark):
    for seed, min_words in ((4, 3), (6, 20)):
        r = random.Random(seed)
        line = [" ".join("abcdefgh"[:r.randrange(0, 9)]) for _ in range(5)]
        docs = [(i, "\n".join(r.choice(line) for _ in range(r.randrange(0, 30)))) for i in range(30)]
        assert deleted(spark, docs, min_words) == maximal(docs, min_words)
