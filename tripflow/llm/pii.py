"""Personal data by weak supervision. DataFrame functions only.

Candidates come from patterns: the base ones, and broader ones (written-out e-mail addresses,
IPv6 addresses, shorter card numbers, phone numbers without a country code). Labelers vote on each
candidate: +1 (personal), -1 (not), 0 (no opinion):

    pattern    did a base pattern match (a broader one says nothing)
    structure  check digits (Luhn), parts of an address in range, form of the name in an address
    gazetteer  ends of domains, issuers of cards with their lengths, country and area codes, address blocks
    context    words before the candidate that announce it, or announce something else
    boundary   does it stand alone, or inside a longer token
    filler     counting or constant digits, as in templates

No labeler looks at what another one looks at, as the estimate takes them for independent. Expectation-
maximisation over the patterns of votes estimates how reliable each labeler is for each kind and
either truth, without any labels; where a kind has few candidates, its estimate leans on that of all
kinds. The posteriors train a logistic span classifier on votes, kind
and length. Both see only a histogram of at most a few thousand cells, however large the corpus,
so they run on the driver; all work on texts and spans runs in Spark.

Base spans that pass their check are always kept. A broader candidate is kept if its structure
holds, it touches no base span, and the classifier gives it at least ``THRESHOLD``.

Defined results: a null text is an empty one; rows that repeat, and null ids, each have their own
result; offsets are code points, the end exclusive; an empty table has an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripflow.llm.common import written

# The kinds in their order, and the limits of the base checks
KINDS = ("email", "ip", "card", "phone")
IP_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

THRESHOLD = 0.5
CONTEXT = 40              # code points before a candidate that the context labeler reads
LABELERS = ("pattern", "structure", "gazetteer", "context", "boundary", "filler")
EM_ROUNDS, FIT_ROUNDS = 60, 400
LEAN = 8.0                # candidates of a kind that outweigh what is known of all kinds


@dataclass(frozen=True)
class Pattern:
    kind: str
    base: bool
    regex: str
    guard: str  # a text that does not match this cannot match the pattern; cheap to test


# The base patterns are the contract's, in a form that needs linear time on any text: possessive,
# and a run of allowed characters is entered at its start only (or where the last match ended).
# Neither changes what matches.
PATTERNS = (
    Pattern("email", True, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Pattern("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    Pattern("card", True, r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]"),
    Pattern("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    Pattern("email", False, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]++"
            r"(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[A-Za-z0-9-]++)++", r"[\[({]at[\])}]"),
    Pattern("ip", False, r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
            r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"),
    Pattern("card", False, r"(?<![0-9A-Za-z])[0-9](?:[\x20-]?[0-9]){12,14}(?![0-9A-Za-z]|[\x20-][0-9])",
            r"[0-9](?:[\x20-]?[0-9]){12}"),
    Pattern("phone", False, r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
            r"[0-9]{3}[\x20.-][0-9]{4}"),
)

# Gazetteers and context words of the labelers. Generic ends of domains (a country's has two
# letters); prefixes and lengths that issuers of cards use; country codes; area codes and exchanges of
# the numbering plan in which ten digits are written without a country code; address blocks of no host
DOMAIN_ENDS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "aero", "coop", "museum", "jobs",
               "mobi", "travel", "tel", "cat", "asia", "post", "xxx", "app", "dev", "cloud", "online", "site", "shop", "blog")
NO_DOMAIN_ENDS = ("test", "example", "invalid", "localhost", "local")
CARD_ISSUERS = ("^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|5[1-5][0-9]{14}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}|"
                "3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11,16}|35(?:2[89]|[3-8][0-9])[0-9]{12,15}|"
                "6(?:011|4[4-9][0-9]|5[0-9]{2}|2[0-9]{2})[0-9]{12,15})$")
COUNTRY_CODES = "^(?:1|2[07]|2[1-689][0-9]|3[0-469]|3[578][0-9]|4[013-9]|42[0-9]|5[1-8]|5[09][0-9]|6[0-6]|6[7-9][0-9]|7|8[1246]|8[058][0-9]|9[0-58]|9[679][0-9])"
AREA_CODES = "^[2-9][0-8][0-9][2-9]"
OPEN_BLOCKS = r"^(?:0|127|255|22[4-9]|23[0-9])\."
CUES = {
    "email": "mail|contact|write to|kontakt|correo|courriel|adresse|reach",
    "ip": r"\bip\b|address|server|host|login|adresse|direcci",
    "card": "card|visa|mastercard|amex|credit|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|whatsapp|handy|anruf|llam|appel",
}
COUNTER_CUES = {
    "email": "example of|format",
    "ip": "version|release|section|kapitel|chapitre",
    "card": "order|invoice|serial|isbn|tracking|rechnung|factura|pedido",
    "phone": "order|invoice|serial|isbn|version|rechnung",
}


def _candidates_of(p: Pattern, matches: Column) -> Column:
    """Pieces between matches, each with the match that follows it (null after the last)."""
    return F.zip_with(F.split("text", p.regex, -1), matches, lambda piece, match: F.struct(
        F.lit(p.kind).alias("kind"), F.lit(p.base).alias("base"), F.length(piece).alias("skip"),
        F.right(piece, F.lit(CONTEXT)).alias("before"), F.left(piece, F.lit(1)).alias("head"), match.alias("match")))


PIECE = "array<struct<kind:string,base:boolean,skip:int,before:string,head:string,match:string>>"


def candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id, kind, base, start, end, match, before, after; a row without kind for each document."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    names = [f"m{k}" for k in range(len(PATTERNS))]
    rows = rows.select("row", "doc_id", "text", *[
        F.when(F.col("text").rlike(p.guard), F.regexp_extract_all("text", F.lit(p.regex), F.lit(0))).alias(n)
        for p, n in zip(PATTERNS, names, strict=True)])
    none = F.array().cast(PIECE)
    found = [F.when(F.size(n) > 0, _candidates_of(p, F.col(n)).cast(PIECE)).otherwise(none)
             for p, n in zip(PATTERNS, names, strict=True)]
    mark = F.array(F.struct(F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.lit(None))).cast(PIECE)
    pieces = rows.select("row", "doc_id", F.posexplode(F.concat(mark, *found)).alias("place", "c")).select(
        "row", "doc_id", "place", "c.*").repartition("row")
    order = W.partitionBy("row", "kind", "base").orderBy("place")
    end = F.sum(F.col("skip") + F.coalesce(F.length("match"), F.lit(0))).over(order)
    return (pieces.withColumn("end", end).withColumn("after", F.lead("head").over(order))
            .where("kind is null or match is not null")
            .select("row", "doc_id", "kind", "base", (F.col("end") - F.length("match")).alias("start"), "end", "match",
                    "before", F.coalesce("after", F.lit("")).alias("after")))


def _luhn(digits: Column) -> Column:
    """The check-digit rule, for texts of digits of moderate length."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _by_kind(values: dict[str, Column]) -> Column:
    out = F.when(F.lit(False), list(values.values())[0])
    for k, v in values.items():
        out = out.when(F.col("kind") == k, v)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out.when(no, -1).otherwise(0) if no is not None else out.otherwise(0)).cast("int")


def voted(found: DataFrame) -> DataFrame:
    """The candidates with ``keep`` (base spans that pass their check), ``sound``, votes and bins."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    df = found.withColumn("digits", digits).withColumn("n", F.length("digits"))
    base, broad = F.col("base"), ~F.col("base")
    # leading zeros do not make a part larger
    parts_ok = ~F.exists(F.split("match", r"\."), lambda x: F.length(F.ltrim(x, F.lit("0"))) > 3) & ~F.exists(
        F.split("match", r"\."), lambda x: F.coalesce(F.left(F.ltrim(x, F.lit("0")), F.lit(3)).try_cast("int"), F.lit(0)) > IP_PART)
    luhn = F.when(F.col("n").between(12, CARD_DIGITS[1]), _luhn(F.col("digits"))).otherwise(False)
    sound = _by_kind({
        "email": F.lit(True),
        "ip": broad | parts_ok,
        "card": luhn & F.when(base, F.col("n").between(*CARD_DIGITS)).otherwise(F.col("n").between(13, 15)),
        "phone": F.when(base, F.col("n").between(*PHONE_DIGITS)).otherwise(F.col("n") == 10),
    })
    before = F.lower("before")
    last = F.lower(F.regexp_extract("match", "([A-Za-z0-9-]+)$", 1))
    gazetteer = _by_kind({
        "email": _vote(last.isin(*DOMAIN_ENDS) | last.rlike("^[a-z]{2}$"), last.isin(*NO_DOMAIN_ENDS) | ~last.rlike("^[a-z]{2,24}$")),
        "ip": _vote(F.lit(False), F.col("match").rlike(OPEN_BLOCKS)),
        "card": _vote(F.col("digits").rlike(CARD_ISSUERS), ~F.col("digits").rlike(CARD_ISSUERS)),
        "phone": _vote(F.when(base, F.col("digits").rlike(COUNTRY_CODES)).otherwise(F.col("digits").rlike(AREA_CODES)),
                       F.when(base, ~F.col("digits").rlike(COUNTRY_CODES)).otherwise(~F.col("digits").rlike(AREA_CODES))),
    })
    cue = {k: before.rlike(v) for k, v in CUES.items()}
    counter = {k: before.rlike(v) for k, v in COUNTER_CUES.items()}
    filler = F.col("digits").rlike(r"^(\d)\1{7,}$") | F.col("digits").rlike("^(?:0?123456789|9876543210)")
    joined = F.right("before", F.lit(1)).rlike(r"[\p{L}\p{N}_]") | F.col("after").rlike(r"[\p{L}\p{N}_]")
    # a name of up to 64 characters without dots at its ends or in a row; digits in groups of two to four
    name = F.regexp_extract("match", r"^([A-Za-z0-9._%+-]+)", 1)
    neat = (F.length(name) <= 64) & (F.length("match") <= 254) & ~name.rlike(r"^\.|\.$|\.\.")
    grouped = F.col("sound") & F.col("match").rlike(r"[0-9][\x20().-]+[0-9]")
    votes = {
        "pattern": _vote(base),
        "structure": _by_kind({
            "email": _vote(neat, ~neat),
            "ip": _vote(F.col("sound"), ~F.col("sound")),
            "card": _vote(luhn, ~luhn),
            "phone": _vote(grouped, ~F.col("sound"))}),
        "gazetteer": gazetteer,
        "context": _by_kind({k: _vote(cue[k], counter[k]) for k in KINDS}),
        "boundary": _vote(~joined, joined),
        "filler": _vote(F.lit(False), filler),
    }
    df = df.withColumn("sound", F.coalesce(sound, F.lit(False)))
    return df.select("row", "doc_id", "kind", "base", "start", "end", "sound", (base & F.col("sound")).alias("keep"),
                     *[votes[j].alias(j) for j in LABELERS],
                     F.least(F.floor(F.length("match") / 8), F.lit(4)).cast("int").alias("size_bin"))


@dataclass
class SpanModel:
    """What is learned: reliabilities of the labelers, and the weights of the span classifier."""

    prior: np.ndarray         # [kind]: share of personal data among candidates
    reliability: np.ndarray   # [kind, labeler, truth, vote + 1]
    kind_weight: np.ndarray   # [kind]
    vote_weight: np.ndarray   # [labeler, vote + 1]
    size_weight: np.ndarray   # [kind, size bin]

    def margin(self) -> Column:
        """The classifier's log odds of a candidate, as an expression on its row."""
        kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
        pick = lambda values, at: F.element_at(F.array(*[F.lit(float(x)) for x in values]), at)
        out = pick(self.kind_weight, kind)
        for j, w in zip(LABELERS, self.vote_weight, strict=True):
            out = out + pick(w, F.col(j) + 2)
        bins = self.size_weight.shape[1]
        return out + pick(self.size_weight.ravel(), (kind - 1) * bins + F.col("size_bin") + 1)


def estimate(cells: list[tuple]) -> SpanModel:
    """EM over vote patterns, then a logistic fit to the posteriors.

    ``cells``: (kind, votes of all labelers, size bin, count).
    """
    k = np.array([KINDS.index(c[0]) for c in cells], int)
    v = np.array([c[1:1 + len(LABELERS)] for c in cells], int).reshape(len(cells), len(LABELERS)) + 1
    size, n = np.array([c[-2] for c in cells], int), np.array([c[-1] for c in cells], float)
    j = np.arange(len(LABELERS))
    # start from the majority; the pseudo-counts say that a labeler is more often right than wrong
    post = 1 / (1 + np.exp(-(v - 1).sum(1).astype(float)))
    pseudo = np.array([[2.0, 1.0, 0.5], [0.5, 1.0, 2.0]])
    prior = np.full(len(KINDS), 0.5)
    theta = np.tile(pseudo / pseudo.sum(1, keepdims=True), (len(KINDS), len(LABELERS), 1, 1))
    for _ in range(EM_ROUNDS if len(cells) else 0):
        seen = np.zeros_like(theta)
        for truth, weight in ((0, (1 - post) * n), (1, post * n)):
            for i in j:
                np.add.at(seen, (k, i, truth, v[:, i]), weight)
        pooled = seen.sum(0) + pseudo
        pooled /= pooled.sum(2, keepdims=True)
        theta = seen + LEAN * pooled
        theta /= theta.sum(3, keepdims=True)
        for i in range(len(KINDS)):
            prior[i] = ((post * n)[k == i].sum() + 1) / (n[k == i].sum() + 2)
        log_odds = np.log(prior[k]) - np.log(1 - prior[k]) + (
            np.log(theta[k[:, None], j, 1, v]) - np.log(theta[k[:, None], j, 0, v])).sum(1)
        post = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    weights = [np.zeros(len(KINDS)), np.zeros((len(LABELERS), 3)), np.zeros((len(KINDS), 5))]
    squares = [np.full_like(w, 1e-8) for w in weights]
    for _ in range(FIT_ROUNDS if len(cells) else 0):
        m = weights[0][k] + weights[1][j, v].sum(1) + weights[2][k, size]
        g = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - post) * n / n.sum()
        slopes = [np.zeros_like(w) for w in weights]
        np.add.at(slopes[0], k, g)
        for i in j:
            np.add.at(slopes[1][i], v[:, i], g)
        np.add.at(slopes[2], (k, size), g)
        for w, s, q in zip(weights, slopes, squares, strict=True):
            s += 1e-4 * w
            q += s * s
            w -= 0.5 * s / np.sqrt(q)
    return SpanModel(prior, theta, *weights)


def fit(votes: DataFrame) -> SpanModel:
    """The model of all candidates: their histogram has at most 4 x 3^6 x 5 cells."""
    cells = votes.where("kind is not null").groupBy("kind", *LABELERS, "size_bin").count()
    order = sorted(tuple(r) for r in cells.collect())
    return estimate(order)


def spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """row, doc_id, kind, start, end, keep (a base span), score of each accepted span.

    A row without kind stands for each document.
    """
    votes = written(voted(candidates(docs)), "pii-votes")
    model = fit(votes)
    # what base spans of the same document reach up to a candidate's start, and begin behind it
    w = W.partitionBy("row").orderBy("start", "end")
    behind = F.max(F.when(F.col("keep"), F.col("end"))).over(w.rowsBetween(W.unboundedPreceding, 0))
    ahead = F.min(F.when(F.col("keep"), F.col("start"))).over(w.rowsBetween(0, W.unboundedFollowing))
    free = (F.coalesce("behind", F.lit(0)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end"))
    score = 1 / (1 + F.exp(-model.margin()))
    return (votes.withColumn("behind", behind).withColumn("ahead", ahead).withColumn("score", score)
            .where(F.col("kind").isNull() | F.col("keep")
                   | (~F.col("base") & F.col("sound") & free & (F.col("score") >= threshold)))
            .select("row", "doc_id", "kind", "start", "end", "keep", "score"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def summary(found: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of base spans by kind, digest of the base spans, all spans."""
    at = F.struct(F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("order"),
                  F.col("start"), F.col("end"), F.col("kind"), F.col("keep"))
    listed = F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), at)))
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    grouped = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), listed.alias("all"))
    base = F.filter("all", lambda s: s["keep"])
    return grouped.withColumn("base", base).select(
        "doc_id", *[F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.col("all")).alias("spans"))
