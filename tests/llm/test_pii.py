from __future__ import annotations

import hashlib
import random
import re

from tripflow.llm import pii
from .helpers import awkward, empty

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            n = sum(c.isdigit() for c in m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 16 <= n <= 19 and luhn(m[0]) or kind == "phone" and 8 <= n <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    "a@b.c.@d.e x+y@z-1.com-", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.0003.4 1.2.3", "4111 1111 1111 1111-4111",
    "+1 (017) 555-7713+49 30 12345678 +1", "a@b..c a@b.c-d@e.f +1.2.3.4.5.6.7.8.9", "99999999999999999999.1.1.1 1.1.1.1.",
    "a" * 5000 + "@" + "b" * 100 + ".c." + "d" * 1000, "1" * 3000, "+1+2+3" * 50, "4111-1111-1111-1111 x5500 0000 0000 0004",
    "😀 é x@y.z 😀 10.0.0.1", "", None, "card 4111111111111112 4111111111111111", "@@ a@ @b.c a@b", "+" * 300, "1 2 3 4 5 6 7 8 9 0" * 30,
]


def test_base_spans_are_exact(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.summary(pii.spans(df)).collect()}
    for i, t in enumerate(TEXTS):
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, got[i])
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [
            sum(w.startswith(k) for w in want) for k in BASE]
        assert set(want) <= set(got[i].spans.split(",")) | {""}



def test_the_method_adds_spans_and_leaves_the_rest(spark):
    good = [f"mail me: ann{i}@mail.example.com or call +1 (212) 555-{1000 + i}, card 4111111111111111, ip 10.{i % 200}.3.4"
            for i in range(60)]
    bad = [f"order 41111111111111{i:02d} version 999.{i}.1.300 x" for i in range(60) if not luhn(f"41111111111111{i:02d}")]
    extra = ["write to joe (at) example (dot) com today", "call (212) 555-2671 now", "amex card 378282246310005 ok",
             "server 2001:0db8:85a3:0000:0000:8a2e:0370:7334 up", "order 378282246310006 is no card"]
    texts = [*good, *bad, *extra]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.summary(pii.spans(df)).collect()}
    n = len(good) + len(bad)
    assert [got[n + k].spans for k in range(5)] == ["email:9:35", "phone:5:19", "card:10:25", "ip:7:46", ""]
    assert all(got[n + k].n_email + got[n + k].n_ip + got[n + k].n_card + got[n + k].n_phone == 0 for k in range(5))
    assert all(got[len(good) + k].spans == "" for k in range(len(bad)))
    assert all(got[k].spans.count(",") == 3 for k in range(len(good)))


def test_em_finds_reliable_labelers():
    # 'structure' follows the truth, 'gazetteer' is noise
    cells = []
    for truth in (0, 1):
        for structure in (-1, 1):
            for gazetteer in (-1, 1):
                right = structure == (1 if truth else -1)
                cells.append(("card", 1 if truth else -1, structure, gazetteer, 0, 1, 0, 2, 950 if right else 50))
    m = pii.estimate(cells)
    s, g = pii.LABELERS.index("structure"), pii.LABELERS.index("gazetteer")
    r = m.reliability[pii.KINDS.index("card")]
    assert r[s, 1, 2] > 0.9 and r[s, 0, 0] > 0.9
    assert abs(r[g, 1, 2] - r[g, 0, 2]) < 0.05
    assert m.vote_weight[s, 2] - m.vote_weight[s, 0] > 5 * abs(m.vote_weight[g, 2] - m.vote_weight[g, 0])


def test_reliabilities_are_of_a_kind():
    """A labeler may be right for one kind and of no use for another."""
    cells = []
    for kind in ("card", "email"):
        for truth in (0, 1):
            for context in (-1, 1):
                right = context == (1 if truth else -1)
                n = (950 if right else 50) if kind == "card" else 500
                cells.append((kind, 1 if truth else 0, 1 if truth else -1, 0, context, 1, 0, 2, n))
    m = pii.estimate(cells)
    c, at = pii.LABELERS.index("context"), pii.KINDS.index
    assert m.reliability[at("card"), c, 1, 2] > 0.9 and m.reliability[at("card"), c, 0, 0] > 0.9
    assert abs(m.reliability[at("email"), c, 1, 2] - 0.5) < 0.1


def test_added_spans_against_planted_truth(spark):
    r = random.Random(6)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def amex(valid):
        while True:
            s = r.choice(["34", "37"]) + digits(13)
            if luhn(s) == valid:
                return s
    planted, texts = [], []
    for i in range(400):
        word = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(6))
        good = r.random() < 0.5
        kind = r.choice(["email", "card", "phone", "ip"])
        if kind == "email":
            span = f"ann{i} (at) example (dot) {r.choice(['com', 'org', 'de'])}" if good else f"ann{i} [at] {digits(2)} [dot] {digits(3)}"
            cue = "please write to " if good else "the format is "
        elif kind == "card":
            span, cue = amex(good), "credit card " if good else "order number "
        elif kind == "phone":
            span = f"({r.choice('2345678')}{r.randrange(10, 89)}) {r.choice('23456789')}{digits(2)}-{digits(4)}" if good else f"{digits(3)} {digits(3)} {digits(3)}"
            cue = "call me " if good else "invoice "
        else:
            span = ":".join("".join(r.choice("0123456789abcdef") for _ in range(4)) for _ in range(8)) if good else f"{digits(4)}:{digits(4)}:{digits(2)}"
            cue = "server address " if good else "version "
        text = f"{word} {cue}{span} {word}"
        planted.append(f"{kind}:{text.index(span)}:{text.index(span) + len(span)}" if good else "")
        texts.append(text)
    # base spans, from which the labelers are learned
    texts += [f"mail bob{i}@mail.example.com or call +1 (212) 555-{1000 + i}, card 4111 1111 1111 1111, ip 10.{i % 200}.3.4" for i in range(150)]
    got = {x.doc_id: x.spans for x in pii.summary(pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    found = [got[i] for i in range(len(planted))]
    hits = sum(f == p for f, p in zip(found, planted, strict=True) if p)
    false = sum(f != p for f, p in zip(found, planted, strict=True) if f)
    assert hits / sum(p != "" for p in planted) > 0.95 and false / max(1, sum(f != "" for f in found)) < 0.05


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")
    plan = df._sc._jvm.PythonSQLUtils.explainString(pii.candidates(df)._jdf.queryExecution(), "formatted")
    assert not any(x in plan for x in ("EvalPython", "ArrowEval", "MapIn", "FlatMap"))


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = pii.summary(pii.spans(docs)).collect()
    assert len(got) == docs.count() and all(r.spans == "" for r in got)
    assert pii.summary(pii.spans(empty(spark))).count() == 0
