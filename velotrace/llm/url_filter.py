"""URL rules with block decisions carried over redirects and canonical links.

A rule is a host and the start of a path and fits the host and its subdomains. A url's own longest
rule decides. A url without a rule of its own is blocked if a block rule decides for any url that
redirects and canonical links connect it with, through any number of steps; otherwise it is allowed.
An explicit allow rule therefore always stands against a block that only comes over links.

Urls meet rules by equality of a host suffix and a path start, so rule tables may be large; urls
with equal keys are spread if the rule table is too large to broadcast.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule, has no
links and is allowed. Repeated rows are judged alike. Of two rules with equal host and path, allow
stands. No rules allow everything. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrace.llm.common import lower_ascii
from velotrace.llm.components import components
from velotrace.operators.joins import lookup
from velotrace.session import written

ALLOW, BLOCK = "allow", "block"
#: Query parameters that do not change what a url shows.
TRACKING = r"(utm_\w+|ref|fbclid|gclid)"
TAG = re.compile(r"<(link|meta|base)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
REFRESH = re.compile(r"^[\s\d.]*[;,\s]\s*url\s*=\s*(.+?)\s*$", re.IGNORECASE)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?`` or ``#``, with A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tidy(url: Column) -> Column:
    """The address that a site's usual redirects end at: https, no ``www.`` or ``m.`` before the
    host, no tracking parameters, fragment, ``.html`` or closing slash."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(\.html?|/)$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(
        F.filter(F.split(query, "&"), lambda p: ~p.rlike(f"^{TRACKING}(=|$)") & (p != "")), "&"
    )
    asked = F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))
    return F.when(host != "", F.concat(F.lit("https://"), host, path, asked))


def _attributes(tag: str) -> dict[str, str]:
    """Attribute names in lower case with their values, the first of each name."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(tag):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def targets_of(url: str, page: str) -> list[str]:
    """The absolute addresses of all canonical links and refreshes of a page.

    Relative addresses, those without a scheme and those without a host are resolved against the
    page's ``base`` if it has one, or else its url; addresses that cannot be resolved are no links.
    """
    asked, base = [], url
    for kind, inner in TAG.findall(page):
        tag, kind = _attributes(inner), kind.lower()
        if kind == "link" and "canonical" in tag.get("rel", "").lower().split():
            asked.append(tag.get("href", ""))
        elif kind == "meta" and tag.get("http-equiv", "").strip().lower() == "refresh":
            asked += [m.strip("\"'") for m in REFRESH.findall(tag.get("content", ""))]
        elif kind == "base" and base == url and tag.get("href"):
            base = _resolved(url, tag["href"]) or url
    found = [_resolved(base, target) for target in asked]
    return list(dict.fromkeys(t for t in found if t))


def _resolved(base: str, target: str) -> str | None:
    try:
        found = urljoin(base, target.strip()) if target.strip() else ""
    except ValueError:
        return None
    return found if "://" in found else None


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): each page's url with its tidy form, its canonical links and its refresh targets."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(u, t) for u, page in zip(*(c.to_pylist() for c in batch.columns)) for t in targets_of(u, page)]
            columns = [pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    named = pages.filter(F.instr("url", "://") > 0)
    linking = named.filter(F.col("html").rlike("(?i)canonical|refresh")).select("url", "html")
    linked = named.select(F.col("url").alias("a"), tidy(F.col("url")).alias("b")).unionByName(
        linking.mapInArrow(read, "a string, b string")
    )
    return linked.filter("b is not null and a <> b").distinct()


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path) with its longest fitting rule: adds ``rule`` and ``rule_verdict``, else null."""
    # Of equal rules allow is kept: it comes before block.
    stated = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    stated = written(
        stated.select(F.col("host").alias("suffix"), F.col("path").alias("begin"), "verdict"), "rules"
    )
    # As many lengths as the longest path has characters, at most.
    lengths = stated.agg(F.array_sort(F.collect_set(F.length("begin")))).first()[0]
    if not lengths:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("rule_verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    begins = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    keys = (
        urls.select("host", "path")
        .distinct()
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("begin", F.explode_outer(begins))
    )
    met = lookup(keys, stated, ["suffix", "begin"])
    rule = F.concat("suffix", "begin")
    best = F.max(
        F.when(
            F.col("verdict").isNotNull(),
            F.struct(F.length(rule).alias("n"), F.length("suffix").alias("m"), rule.alias("rule"), "verdict"),
        )
    )
    return met.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict")
    )


def judge(urls: DataFrame, rules: DataFrame, links: DataFrame) -> DataFrame:
    """(url) to (url, host, path, rule, verdict), one row per different url.

    ``rules`` has (host, path, verdict); ``links`` has (a, b), the urls of redirects and canonical
    links in either direction.
    """
    known = written(
        urls.select("url")
        .unionByName(links.select(F.col("a").alias("url")))
        .unionByName(links.select(F.col("b").alias("url")))
        .distinct()
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}),
        "urls",
    )
    decided = written(rule_of(known, rules), "decided")
    judged = written(
        known.join(decided, ["host", "path"], "left"), "judged"
    )
    member = written(components(links), "components")
    blocked = (
        member.join(judged.filter(F.col("rule_verdict") == BLOCK), member["node"] == judged["url"])
        .select("component")
        .distinct()
        .withColumn("spoiled", F.lit(True))
    )
    inherited = lookup(member, written(blocked, "spoiled"), ["component"]).filter("spoiled")
    asked = judged.join(inherited.select(F.col("node").alias("url"), "spoiled"), "url", "left")
    return asked.select(
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.when(F.col("spoiled"), BLOCK), F.lit(ALLOW)).alias("verdict"),
    )


def judge_pages(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Every page with host, path, rule and verdict; links are read from the pages by default."""
    links = written(page_links(pages) if links is None else links.select("a", "b"), "links")
    verdicts = written(judge(pages.filter("url is not null").select("url"), rules, links), "verdicts")
    met = lookup(pages.select("page_id", "url"), verdicts, ["url"])
    return met.select(
        "page_id",
        "url",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"),
    )
