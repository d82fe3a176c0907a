"""Hosts, paths and rules against plain Python; components by hand."""

from __future__ import annotations

import re

from lustra.llm.redirect_filter import RULES, declared_links, judge_urls

SF = "/root/testdata/sf0.001/pages.parquet"
PAGES = "page_id long, url string, html string, host string, node string, component string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


URLS = [
    None, "", "no url", "https://Example.NET/en/x?y#z", "http://a.example.net/enx", "http://net/", "http://net", "//x.net/a",
    "http://xnet/a", "https://www.EXAMPLE.com/de/", "https://www.example.com/de", "https://b.org/fr/1", "https://b.org/FR/1",
    "x://y://z.net/q", "http://É.net/ü", "https://h.org?x/y", "https://h.net#/fr/", "http://u@example.net:80/en/", "://a.net/",
    "http://line\nfeed.net/x\ny",
]


def test_parts_and_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] * 2
    out = judge_urls(pages(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path = parts(URLS[r.page_id])
        own = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, own and own.name)
        assert r.verdict == ("block" if own and not own.allows else "allow")


def test_given_pages(spark):
    given = spark.read.parquet(SF)
    urls = {r.page_id: r.url for r in given.collect()}
    for r in judge_urls(given).collect():
        host, path = parts(urls[r.page_id])
        own = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, own and own.name)


CANONICAL = '<html><link rel="canonical" href="{}"></html>'


def test_blocks_reach_aliases_and_allows_come_first(spark):
    rows = [
        (1, "http://a.net/x", CANONICAL.format("https://b.com/y?a=1&amp;b=2")),
        (2, "https://b.com/y?a=1&b=2#top", None),
        (3, "https://c.com/q", "<META HTTP-EQUIV=refresh content=\"0; url='https://b.com/y?a=1&b=2'\">"),
        (4, "https://d.com/", "<link rel=alternate href=http://a.net/x>"),
        (5, "https://sub.example.net/en/1", CANONICAL.format("http://k.com/k")),
        (6, "http://k.com/k", CANONICAL.format("http://z.net/")),
        (7, "http://m.com", CANONICAL.format("//q.net/")),
        (8, "http://n.com/d/e", CANONICAL.format("/d/f")),
        (9, "http://n.com/d/f", CANONICAL.format("g")),
        (10, "http://n.com/d/g", CANONICAL.format("mailto:x")),
        (11, "http://example.com/de/", CANONICAL.format("http://n.com/d/g")),
    ]
    out = {r.page_id: r for r in judge_urls(pages(spark, rows)).collect()}
    assert {k: r.verdict for k, r in out.items()} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "block",
        10: "block", 11: "block",
    }
    assert out[1].component == out[2].component == out[3].component
    assert out[4].component is None
    assert out[8].component == out[11].component


def test_dot_segments_of_aliases(spark):
    hrefs = ["../x/", "./../x/", "../../../../x/", "/a/b/c/../../.././x/.", "http://h.net/q/../x/y/..", "../x/?q=/../z#t"]
    rows = [(i, f"https://p{i}.com/d/e", CANONICAL.format(h)) for i, h in enumerate(hrefs)]
    goals = [f"https://p{i}.com/x/" for i in range(4)] + ["http://h.net/x/", "https://p5.com/x/?q=/../z"]
    rows += [(10 + i, g, CANONICAL.format("http://b.net/")) for i, g in enumerate(goals)]
    rows += [(20, "http://k.com/a/../b", CANONICAL.format("http://b.net/")), (21, "http://k.com/...", CANONICAL.format("b"))]
    rows += [(22, "http://k.com/.b/c..", None)]
    out = {r.page_id: r for r in judge_urls(pages(spark, rows)).collect()}
    assert {r.component for i, r in out.items() if i < 22} == {"http://b.net/"} and out[22].component is None
    assert {r.verdict for i, r in out.items() if i < 22} == {"block"} and out[20].path == "/a/../b"


def test_redirect_table(spark):
    moved = spark.createDataFrame([("http://a.com/1", "http://b.com/2"), ("http://b.com/2", "http://c.net/3"), (None, "http://b.com/2")], "source string, target string")
    out = judge_urls(pages(spark, [(1, "http://a.com/1", ""), (2, "http://a.com/2", "")]), redirects=moved).collect()
    assert {r.page_id: r.verdict for r in out} == {1: "block", 2: "allow"}


def test_no_python_on_the_executors(spark):
    plan = judge_urls(spark.read.parquet(SF))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_table(spark):
    assert judge_urls(pages(spark, [])).collect() == []
    assert declared_links(pages(spark, [(1, None, None), (2, "http://a.b/", "canonical")])).collect() == []
