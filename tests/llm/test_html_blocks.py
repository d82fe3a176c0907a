"""Main text of pages: the given ones by their markup, others by hand."""

from __future__ import annotations

import html
import re

import pytest

from lustra.llm.html_blocks import LABELLED, article_tree, blocks, extract_main_text, grow, main_text

SF = "/root/testdata/sf0.001/pages.parquet"


def by_markup(page):
    """The given pages hold their article in one element, with paragraphs and a heading."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside))
    return "\n\n".join(x for x in parts if x)


def test_given_pages(spark):
    pages = spark.read.parquet(SF)
    texts = {r.page_id: (r.url, r.text, r.n_chars) for r in extract_main_text(pages).collect()}
    for r in pages.collect():
        wanted = by_markup(r.html)
        assert texts[r.page_id] == (r.url, wanted, len(wanted))


FULL = """<html><head><title>T</title><style>a{}</style></head><body>
<header class="site-header"><a href="/">Site</a><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies to improve your experience here, please accept all of them now.</p></div>
<main><article class="post"><header class="entry-header"><h1>Big  Title &amp; more</h1></header>
<p>First para with a <a href=x>link</a> and&nbsp;text.<p>Second one.<br>Line two.
<div class="ad-slot"><p>Buy the thing now for little money in this advert of ours.</p></div>
<ul><li>item one</li><li>item two</li></ul>
<aside class="related"><h3>Related</h3><a href=q>Other story</a></aside>
<form><p>Subscribe to our newsletter</p><input></form><p>Last words.</p></article>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I think this text is great and should be read.</p></article>
</section></main><div id="sidebar"><p>Popular posts this week that you should really read.</p></div>
<footer><p>&copy; 2020 Site</p></footer><script>var a="<p>x</p>"</script></body></html>"""
PLAIN = """<body><div id="menu"><a href=1>One</a> <a href=2>Two</a></div><h1>Plain page title</h1>
<p>This is a long paragraph of main text in a page without an article element, with many words.</p><p>Short one.</p>
<p>Another paragraph with a sufficient number of words to be seen as main text by anyone.</p>
<div class="footer">Copyright 2021 Someone</div>"""


def test_furniture_goes_and_the_article_stays():
    assert main_text(FULL, article_tree()).split("\n\n") == [
        "Big Title & more",
        "First para with a link and text.",
        "Second one. Line two.",
        "item one",
        "item two",
        "Last words.",
    ]
    assert main_text(PLAIN, article_tree()).split("\n\n")[0] == "Plain page title"
    assert len(main_text(PLAIN, article_tree()).split("\n\n")) == 4


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []),
        ("plain text < 3 & more", ["plain text < 3 & more"]),
        ("<p>a<b>b</b>c<p>d", ["abc", "d"]),
        ("<script>x<p>y", []),
        ("<!-- <p>no</p>", []),
        ("<p title='a>b'>c</p>", ["c"]),
        ("&lt;p&gt;&#233;&eacute;&amp;lt;", ["<p>éé&lt;"]),
        ("<div><div>a</div>b</div>c", ["a", "b", "c"]),
        ("</div></p>a</nav>", ["a"]),
        ("<", ["<"]),
    ],
)
def test_blocks_of_broken_markup(page, texts):
    assert [b.text for b in blocks(page)] == texts


@pytest.mark.parametrize(
    "page, texts",
    [
        ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', ["one two", "three"]),
        ("<p>a<svg/>b<math display='x>y' />c<p>d", ["abc", "d"]),
        ("<p>a<svg><path d='m/'/>no</svg>b<SVG a=1 />c<svg b='/'>no</svg>d", ["abcd"]),
        ("<p>a<svg-icon name=x></svg-icon>b<video-player>c</video-player><p>d", ["abc", "d"]),
    ],
)
def test_empty_icons_swallow_nothing(page, texts):
    assert [b.text for b in blocks(page)] == texts


ARTICLE = "<article><h1>Title here</h1><p>The main text of the page has quite a few words in it.</p></article>"
TEXT = "Title here\n\nThe main text of the page has quite a few words in it."


@pytest.mark.parametrize(
    "wrapper",
    [
        '<div class="overflow-hidden">', '<div style="overflow:hidden">', '<div data-hidden="true" title="display: none">',
        '<div class="content has-sidebar">', '<section class="no-sidebar">', '<div id="layout-with-sidebar">',
        '<div class="page-sidebar">', '<div class="notice">', '<form id="aspnetForm">', '<div class="comments-open">',
        '<div class="widget"><div data-role="footer"><main>', "<div hidden=until-found>",
    ],
)
def test_wrappers_keep_the_article(wrapper):
    assert main_text(f"<body>{wrapper}{ARTICLE}</body>", article_tree()) == TEXT
    after = '<section class="comments"><article><p>Nice text, I read it all and shall read it again soon.</p></article></section>'
    assert main_text(f"<body>{wrapper}{ARTICLE}</div></section></form>{after}", article_tree()).startswith(TEXT)


@pytest.mark.parametrize(
    "other",
    [
        "<div hidden>{}</div>", "<div HIDDEN=''>{}</div>", '<div style="color:red; Display : none">{}</div>',
        "<div aria-hidden=true>{}</div>", '<section id="comments"><article>{}</article></section>',
        '<aside><article>{}</article></aside>', '<div class="sidebar">{}</div>', '<article class="comment">{}</article>',
        '<div class="related-posts"><article>{}</article><article>{}</article></div>', "<div class='ad no-border'>{}</div>",
    ],
)
def test_furniture_beside_the_article_goes(other):
    page = ARTICLE + other.replace("{}", "<p>Other words that are not of this text but of some other one.</p>")
    assert main_text(page, article_tree()) == TEXT


def test_many_open_wrappers():
    page = '<div class="ad">' * 20_000 + ARTICLE
    assert main_text(page, article_tree()) == TEXT


def test_links_and_containers():
    one, two = blocks("<nav>a b <a>c d</a></nav><article><h2>e <a>f</a></h2></article>")
    assert (one.words, one.linked, one.furniture, one.article) == (4, 2, True, False)
    assert (two.words, two.linked, two.furniture, two.article, two.heading) == (2, 1, False, True, True)
    assert [b.furniture for b in blocks('<div class="post-header">a</div><p class="topAd">b<p>c<div hidden>d</div>e')] == [
        False, True, False, True, False,
    ]


def test_tree_fits_its_table():
    import numpy as np

    table = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    assert (article_tree().says(table[:, :-1]) == (table[:, -1] == 1)).mean() >= 0.97
    assert grow(table[:, :-1], table[:, -1]) == article_tree()


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "t", "n"), (2, "u", "", "t", "n"), (None, "u", FULL, "t", "n"), (3, "u", "<p>" * 5000, "t", "n")]
    long = "<article>" + "<p>word word word</p>" * 20_000 + "</article>"
    out = extract_main_text(spark.createDataFrame([*rows, (4, "u", long, "t", "n"), (4, "u", long, "t", "n")], schema)).collect()
    found = {r.page_id: (r.url, r.n_chars) for r in out}
    assert found[1] == (None, 0) and found[2] == ("u", 0) and found[3] == ("u", 0) and found[None][1] > 50
    assert found[4][1] == 20_000 * 16 - 2 and len(out) == 6
    assert extract_main_text(spark.createDataFrame([], schema)).collect() == []
