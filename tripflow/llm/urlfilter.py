"""URL rules with redirect equivalence: blocks reach the aliases of a page.

A rule is a verdict, a host and a path; it fits the host and its subdomains where a URL's path
starts with the rule's path. Of the rules that fit, the one with the longest text (host and path)
decides. A URL without such a rule has the verdict of its aliases: URLs are linked by redirects
(``<meta http-equiv=refresh>`` of a page, or rows of a redirect table) and by canonical links
(``<link rel=canonical>``), and distributed connected components over these links make the classes of
aliases. A class with a blocked URL blocks its URLs, unless it also holds an explicitly allowed
one: an explicit allow has precedence, for the URL itself and for its aliases.

As an alias a URL is its host, path and query: scheme and fragment do not count, and an empty path
is ``/``. Link targets are resolved against the page's URL; targets without ``://`` after that are
no links. Links in comments and scripts do not count. Only link targets, rules and roots are
shuffled, never pages' texts; links of one URL that very many pages share are split by Spark
(``components``).

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule and no
aliases, and is allowed; a null or empty text has no links; repeated rows are each judged; pages
of equal URLs are one alias; an empty table has an empty result. Other columns are ignored.
"""

from __future__ import annotations

import html
from collections.abc import Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tripflow.llm.common import written
from tripflow.llm.components import components

ALLOW, BLOCK = "allow", "block"
# (verdict, host, path)
RULES = [(ALLOW, "org", "/"), (BLOCK, "example.org", "/es/"), (BLOCK, "example.org", "/en/1"),
         (ALLOW, "com", "/fr/"), (BLOCK, "com", "/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# markup in which links do not count, and the tags and attributes that hold links
_SILENT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
_TAGS = r"(?i)<(?:link|meta)\s[^>]*>"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def alias_of(url: Column) -> Column:
    """Digest of host, path and query; null for a URL without a scheme."""
    path = path_of(url)
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*(\?[^#]*)?", 1)
    text = F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query)
    return F.when(F.locate("://", url) > 0, F.unhex(F.md5(text)))


def deciding_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Place in ``rules`` of the rule that decides, null if none fits."""
    at = F.lit(None).cast("int")
    longest_last = sorted(range(len(rules)), key=lambda k: (len(rules[k][1] + rules[k][2]), rules[k][1] + rules[k][2]))
    for k in longest_last:
        _, own, start = rules[k]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        at = F.when(fits, F.lit(k)).otherwise(at)
    return at


def _named(place: Column, names: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in names]), place) if names else F.lit(None).cast("string")


def judged(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``urls`` with host, path, rule (its text) and ruling (its verdict), both null without a rule."""
    df = urls.withColumns({"host": F.coalesce(host_of(F.col("url")), F.lit("")), "path": F.coalesce(path_of(F.col("url")), F.lit(""))})
    df = df.withColumn("at", deciding_rule(F.col("host"), F.col("path"), rules))
    return df.withColumns({"rule": _named(F.col("at"), [h + p for _, h, p in rules]),
                           "ruling": _named(F.col("at"), [v for v, _, _ in rules])}).drop("at")


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)\s{name}{_VALUE}"
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


@F.pandas_udf(StringType())
def _resolved(base: pd.Series, target: pd.Series) -> pd.Series:
    def one(b: str, t: str) -> str | None:
        try:
            return urljoin(b, html.unescape(t.strip()))
        except ValueError:      # no URL at all
            return None
    return pd.Series([one(b, t) for b, t in zip(base, target, strict=True)], dtype=object)


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target): canonical links and refreshes of the pages, with absolute targets."""
    marked = pages.select("url", "html").where(F.col("html").rlike("(?i)canonical|refresh") & F.contains("url", F.lit("://")))
    tags = marked.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("html", _SILENT, ""), F.lit(_TAGS), F.lit(0))).alias("tag"))
    tag = F.col("tag")
    canonical = tag.rlike(r"(?i)^<link") & F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical")
    refresh = tag.rlike(r"(?i)^<meta") & (F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")
    moved = F.regexp_extract(_attribute(tag, "content"), r"""(?i)^\s*[\d.]*\s*[;,]\s*url\s*=\s*['"]?([^'"\s]+)""", 1)
    found = tags.select("url", F.when(canonical, _attribute(tag, "href")).when(refresh, moved).alias("target"))
    return found.where("target <> ''").select("url", _resolved("url", "target").alias("target")).where(F.contains("target", F.lit("://")))


def blocked_aliases(links: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(alias) of the linked URLs (url, target) whose class is blocked."""
    ends = links.select(F.col("url")).unionByName(links.select(F.col("target").alias("url")))
    nodes = judged(ends, rules).select(alias_of(F.col("url")).alias("node"), "ruling").where("ruling is not null").groupBy("node").agg(
        F.bool_or(F.col("ruling") == BLOCK).alias("block"), F.bool_or(F.col("ruling") == ALLOW).alias("allow"))
    roots = components(links.select(alias_of(F.col("url")).alias("a"), alias_of(F.col("target")).alias("b")))
    # a root is the root of itself; nodes are unique on both sides
    classes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    verdicts = classes.join(nodes, "node").groupBy("root").agg(F.bool_or("block").alias("block"), F.bool_or("allow").alias("allow"))
    blocked = written(verdicts.where("block and not allow").select("root"), "blocked-roots")
    classes = written(classes, "alias-classes")
    return classes.join(blocked, "root").select(F.col("node").alias("alias"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of each page (page_id, url, html).

    ``redirects`` (url, target) are further links, such as those of a crawl log.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target").where(
            F.contains("url", F.lit("://")) & F.contains("target", F.lit("://"))))
    links = written(links.distinct(), "url-links")
    df = judged(pages.select("page_id", "url"), rules)
    if links.isEmpty():
        return df.select("page_id", "host", "path", "rule", F.coalesce("ruling", F.lit(ALLOW)).alias("verdict"))
    blocked = written(blocked_aliases(links, rules), "blocked").withColumn("hit", F.lit(BLOCK))
    # where a rule decides, or a URL has no alias, the key is one that no alias has, another for each row, as
    # null keys would all meet in one task
    spread = F.concat(F.unhex(F.md5(F.monotonically_increasing_id().cast("string"))), F.lit(bytearray(1)))
    key = F.coalesce(F.when(F.col("ruling").isNull(), alias_of(F.col("url"))), spread)
    return df.withColumn("alias", key).join(blocked, "alias", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruling", "hit", F.lit(ALLOW)).alias("verdict"))
