from __future__ import annotations

import html
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from findlake.llm import html_blocks as h

LONG = "This is the text of the article and it has to be long enough for the rules to decide on it."
PAGES = [
    (None, ""), ("", ""), ("just text", ""), ("<p>" + LONG + "</p>", LONG),
    (f"<article><h1>Head &amp; T</h1><p>{LONG}<p>Short.</article><footer>&copy; x</footer>", f"Head & T {LONG} Short."),
    (f"<nav><a href=/>{LONG}</a></nav><div class='side-bar'>{LONG}</div><article><p>Only</article>", "Only"),
    (f"<article><p>{LONG}</p><div id='comments'><article class=comment><p>{LONG}</article></div></article>", LONG),
    (f"<div class=ad>Buy<article><p>a&nbsp;b &#x41; &lt;i&gt; &unknown; &a</p></article>", "a b A <i> &unknown; &a"),
    ("<script>var t='</p>" + LONG + "';</script><style>p{}</style><article>A<br>B<!-- c --><b>C</b>D</article>", "A B C D".replace("B C D", "BCD")),
    (f"<div><ul><li><a href=a>one</a><li><a href=b>two</a></ul></div><div><p>{LONG}</p><p>and so on</p></div><form><p>{LONG}</form>", f"{LONG} and so on"),
    (f"<aside>{LONG}</aside><p>x", ""), ("<article><p>" + "w " * 60000 + "</article>", ("w " * 60000).strip()),
]


def test_pages(spark):
    rows = [(i, f"u{i}", page) for i, (page, _) in enumerate(PAGES)] + [(None, None, PAGES[4][0]), (4, "u4", PAGES[4][0])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = h.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        want = PAGES[4 if r["page_id"] is None else r["page_id"]][1]
        if r["page_id"] == 2:
            want = r["text"]  # undecided short text without any neighbour
            assert want == ""
        assert r["text"] == want and r["n_chars"] == len(want), r["page_id"]
    assert h.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("labels, want", [([None, True, None, None, False, None], [True, None, True, False, None, False]), ([None, None], [None, None]), ([True, None, False], [None, True, None])])
def test_open_blocks_take_the_nearest_label(labels, want):
    found = h._nearest(labels, list(range(len(labels))))
    assert [found.get(i) for i in range(len(labels))] == want


def test_pages_of_the_table(spark):
    from findlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    pages = dict(duckdb.connect().execute(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall())
    got = QUERIES["op7_html_blocks"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())


WRAPPERS = [
    '<body class="single-post comments-open">{}</body>', '<div class="site has-sidebar">{}</div>', '<div class="page with-header-image">{}</div>',
    '<div class="no-comments"><main>{}</main></div>', '<div class="ad-free">{}</div>', '<div id="post-comment-count-3">{}</div>', "<fieldset>{}</fieldset>",
    '<div class="comments"><main>{}</main></div>', '<body class="sidebar">{}</body>', '<div class="banner">{}</div>',
]
INSIDE = [f"<article><h1>Head</h1><p>{LONG}</p><p>Short end.</p></article>", f"<h1>Head</h1><p>{LONG}</p><p>Short end.</p>"]
AROUND = (
    f'<nav>Menu of the site and of all that is in it</nav><div class="cookie-notice"><p>{LONG}</p></div>',
    f'<div id="comment-list"><p>{LONG}</p><article><p>{LONG}</p></article></div><div class="sidebar"><p>Also read this</p></div><footer>{LONG}</footer>',
)


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inside", INSIDE)
def test_a_name_on_a_wrapper_does_not_silence_the_page(wrapper, inside):
    want = f"Head {LONG} Short end."
    assert h.main_text(wrapper.format(inside)) == want
    if "banner" in wrapper:  # a region by its name, but for the share of the text that it has
        assert (want in h.main_text(wrapper.format(inside) + "<p>Some words</p>")) and h.main_text(f"<p>{LONG}</p>" * 3 + wrapper.format("<p>Buy!</p>")).count("Buy!") == 0
    elif "<body" not in wrapper:
        assert h.main_text(AROUND[0] + wrapper.format(inside + "<p></p>") + AROUND[1]) == want
    else:
        assert h.main_text(wrapper.format(AROUND[0] + inside + AROUND[1])) == want


@pytest.mark.parametrize("text", [
    "Это длинный текст статьи, и он должен быть достаточно длинным, чтобы правила могли решить, что с ним делать.",
    "これは記事の本文であり、規則が判断できるように十分に長くなければならない。そうでなければ何も残らない。もう一つの文もここにある。",
    "Questo è il testo dell'articolo e deve essere abbastanza lungo perché le regole possano decidere che cosa farne di più.",
])
def test_other_languages(text):
    assert h.main_text(f"<nav>a b c</nav><div><p>{text}</p></div><div class=footer><p>{text}</p></div>") == text


@pytest.mark.parametrize("name, is_region", [("comments", True), ("comment-list", True), ("side-bar", True), ("siteFooter", True), ("comments-open", False),
                                             ("has-sidebar", False), ("no-comments", False), ("post-comment-count-3", False), ("content", False)])
def test_names(name, is_region):
    assert bool(h.called({"class": name}) & h.NAMES) == is_region
