"""URL rules: parts of urls, longest rule, and block decisions over links."""

import random

import pytest

from velotrace.llm import components, url_filter
from velotrace.llm.url_query import RULES

SCHEMA = "page_id long, url string, html string"


def judged(spark, pages, links=None, rules=RULES):
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r.page_id: r for r in url_filter.judge_pages(pages, rules, links).collect()}


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("http://A.Example.com/En/x?y#z", "a.example.com", "/En/x"),
        ("http://host", "host", ""),
        ("http://host?q/r", "host", ""),
        ("http://host#a?b", "host", ""),
        ("//host/p", "", ""),
        ("", "", ""),
        (None, "", ""),
        ("x://É.org/a://b", "É.org", "/a://b"),
        ("://h/p", "h", "/p"),
    ],
)
def test_parts(spark, frame, url, host, path):
    row = judged(spark, frame(SCHEMA, (1, url, None)))[1]
    assert (row.host, row.path) == (host, path)


def test_longest_rule(spark, frame):
    urls = [
        "http://x.com/a", "http://example.com/en/a", "http://m.example.com/en/", "http://www.example.com/en/a",
        "http://b.www.example.com/en/a", "http://notexample.com/en/a", "http://x.net/es/a", "http://x.net/e",
        "http://x.org/es/", "http://x.com",
    ]
    got = judged(spark, frame(SCHEMA, *[(i, u, "") for i, u in enumerate(urls)]))
    assert [got[i].rule for i in range(len(urls))] == [
        "com/", "example.com/en/", "example.com/en/", "www.example.com/en/", "www.example.com/en/", "com/", "net/es/",
        None, None, None,
    ]
    assert [got[i].verdict for i in range(3)] == ["allow", "block", "block"]


def test_blocks_follow_links_and_allows_stand(spark, frame):
    pages = frame(
        SCHEMA + ", rule string, verdict int, a string",
        (1, "http://x.org/1", '<link rel="canonical" href="http://x.net/es/1">', "r", 1, "a"),
        (2, "http://y.org/2", "<meta http-equiv=refresh content='0; url=http://x.org/1'>", "r", 1, "a"),
        (3, "http://z.com/3", '<link rel=canonical href="http://y.org/2">', "r", 1, "a"),
        (4, "http://w.org/4", "nothing", "r", 1, "a"),
        (5, "http://www.w.org/4/#top", None, "r", 1, "a"),
        (6, None, "x", "r", 1, "a"),
        (6, None, "x", "r", 1, "a"),
        (7, "http://q.org/a", '<link rel="canonical" href="/es/">', "r", 1, "a"),
    )
    got = judged(spark, pages)
    assert [got[i].verdict for i in range(1, 8)] == ["block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert got[3].rule == "com/" and got[1].rule is None


def test_equal_rules_no_rules_and_no_pages(spark, frame):
    page = frame(SCHEMA, (1, "http://a.org/", ""))
    assert judged(spark, page, rules=[("a.org", "/", "block"), ("a.org", "/", "allow")])[1].verdict == "allow"
    assert judged(spark, page, rules=[])[1].verdict == "allow"
    assert judged(spark, spark.createDataFrame([], SCHEMA)) == {}


def test_components_of_chains_stars_and_random_graphs(spark, frame):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(300)]
    loose = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    edges = chain + star + loose + chain[:5] + [(7, 7), (None, 3), (3, None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components.components(frame("a long, b long", *edges)).collect()}
    assert got == {x: root(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize(
    "page, targets",
    [
        ('<link rel="canonical" href="//x.net/es/1">', ["http://x.net/es/1"]),
        ("<link href=c.html rel='alternate Canonical'>", ["http://own.org/a/c.html"]),
        ('<LINK REL=canonical HREF="../x?p=1&amp;q=2">', ["http://own.org/x?p=1&q=2"]),
        ("<link rel=canonical href=/r><link rel=canonical href='http://two.org/'>", ["http://own.org/r", "http://two.org/"]),
        ('<meta http-equiv="Refresh" content="3 ; URL=\'/es/2\'">', ["http://own.org/es/2"]),
        ("<meta content='0;url=http://m.org/?a=b' http-equiv=refresh>", ["http://m.org/?a=b"]),
        ('<base href="http://b.org/d/"><link rel=canonical href="e">', ["http://b.org/d/e"]),
        ('<link rel="stylesheet" href="s.css"><link rel=canonical><meta http-equiv=refresh content=5>', []),
        ('<link rel=canonical href="http://[bad">', []),
        ('<link rel=canonical href="mailto:a@b">', []),
        ("canonical refresh", []),
    ],
)
def test_link_targets_are_resolved(page, targets):
    assert url_filter.targets_of("http://own.org/a/b.html?q", page) == targets


def test_blocks_follow_relative_links(spark, frame):
    pages = frame(
        SCHEMA,
        (1, "http://own.org/a/1", '<link rel=canonical href="//x.net/es/1">'),
        (2, "http://own.org/a/2", '<link rel=canonical href="1">'),
        (3, "http://own.org/b/3", "<meta http-equiv=refresh content='0;url=../a/2'>"),
        (4, "http://own.org/b/4", '<link rel=canonical href="5">'),
    )
    got = judged(spark, pages)
    assert [got[i].verdict for i in (1, 2, 3, 4)] == ["block", "block", "block", "allow"]
