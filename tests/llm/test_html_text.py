"""Main text of pages: the given pages against a plain reading of their article, and planted cases."""

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import html_text as H
from crowdpulse.llm.queries import QUERIES

PROSE = "This is a sentence of the article that goes on for a while, as sentences in articles do. " * 3


def plain(page):
    inside = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1|br|article)>", inside[1]) if inside else []
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_plain_version(spark, sf):
    d = f"/root/testdata/{sf}"
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = QUERIES["op3_html_extraction"](spark, d).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div id='body'>{}</div>", "{}"])
def test_what_is_not_the_article_goes(around):
    article = f"<h1>Title &amp; more</h1><p>{PROSE}</p><p>{PROSE}<b>bold</b> <a href='/x'>link</a> end.</p><p>{PROSE}</p>"
    page = (
        "<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class='page ad-free'>"
        "<header><a href='/'>Home of the site</a></header><nav><ul><li><a href='/a'>A</a><li><a href='/b'>B</a></ul></nav>"
        f"<div class='ad'>{PROSE}</div><div id='cookie-notice'>{PROSE}</div><script>if (a < b) {{ '</p>' }}</script>"
        + around.format(article)
        + f"<aside>{PROSE}</aside><section class='comments'><p>{PROSE}</p></section><div class='sidebar'>{PROSE}</div>"
        f"<form><p>{PROSE}</p><input><button>Go</button></form><footer>&copy; site {PROSE}</footer></body></html>"
    )
    prose = PROSE.strip()
    assert H.extract(page) == f"Title & more\n{prose}\n{prose} bold link end.\n{prose}"


def test_comments_within_the_article_and_broken_markup():
    page = f"<body><article><h2>T</h2><p>{PROSE}<p>{PROSE}<div class='comment-list'><article><p>{PROSE}</article></div><p>end<br>of it"
    assert H.extract(page) == "\n".join(["T", PROSE.strip(), PROSE.strip(), "end", "of it"])
    assert H.extract(f"<p>{PROSE}</i></span> tail</p></div></div><p>x &lt;b&gt; &#233; &unknown;</p>").endswith("tail\nx <b> é &unknown;")
    assert H.extract(None) == H.extract("") == H.extract("<html></html>") == H.extract("<script>x</script>") == ""
    assert H.extract("plain words only") == "plain words only"
    assert H.extract("<p>a\n\t b c</p>") == "a b c"


def test_links_and_menus_without_names_go():
    menu = "".join(f"<div><a href='/{k}'>Section {k}</a></div>" for k in range(30))
    page = f"<body><div>{menu}</div><div><h1>Head</h1><p>{PROSE}</p><p>short.</p><p>{PROSE}</p></div><div>{menu}</div></body>"
    assert H.extract(page) == "\n".join(["Head", PROSE.strip(), "short.", PROSE.strip()])


def test_edges_of_the_table(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>w</p>", "x"), (2, "", "<div>" * 3000 + "deep", "x")]
    rows.append((3, "u", f"<article><p>{'long words ' * 100_000}</p></article>", "x"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.n_chars, r.text[:4]) for r in H.extracted(pages).collect())
    assert got == [(0, 1, "w"), (1, 0, ""), (1, 0, ""), (2, 4, "deep"), (3, 1_099_999, "long")]
    assert H.extracted(pages.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("name", ["content no-sidebar", "has-sidebar", "elementor-widget elementor-widget-text-editor", "page-with-comments"])
def test_wrappers_with_names_in_their_class_stay(name):
    article = f"<h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p>"
    want = "\n".join(["Head", *[PROSE.strip()] * 3])
    comments = f"<section class='comments'><p>{PROSE}</p></section>"
    for inner in (article, f"<article>{article}</article>"):
        assert H.extract(f"<body><div class='{name}'>{inner}</div></body>") == want
        assert H.extract(f"<body><main><div class='{name}'>{inner}</div></main><div class='ad'>{PROSE}</div></body>") == want
    assert H.extract(f"<body><div class='{name}'><article>{article}</article>{comments}</div></body>") == want


def test_paragraphs_with_ordinary_words_in_their_class_stay():
    names = ("share-price", "side-effects", "related-work")
    body = "".join(f"<p class='{n}'>{PROSE}</p>" for n in names)
    assert H.extract(f"<article><p>{PROSE}</p>{body}</article>") == "\n".join([PROSE.strip()] * 4)
    long = "".join(f"<p>{PROSE}</p>" for _ in range(9))
    assert H.extract(f"<article><p>{PROSE}</p></article><div class='comments'><article>{long}</article></div>") == PROSE.strip()


def test_svg_and_math_may_close_themselves():
    for inner in ("<svg class='i'/>", "<svg><path/><g></g></svg>", "<math/>"):
        assert H.extract(f"<article><h1>T</h1>{inner}<p>{PROSE}</p></article>") == f"T\n{PROSE.strip()}"


@pytest.mark.parametrize("name", ["comment-list", "comments", "user_comments", "disqus_thread"])
def test_comments_longer_than_the_article_go(name):
    comments = f"<div class='{name}'><p>{PROSE}</p><p>{PROSE}</p></div>"
    assert H.extract(f"<article><p>{PROSE}</p>{comments}</article>") == PROSE.strip()
    assert H.extract(f"<body><div><p>{PROSE}</p>{comments}</div></body>") == PROSE.strip()


def test_link_lists_within_an_article_go():
    links = "".join(f"<li><a href='/{k}'>Other story {k}</a></li>" for k in range(4))
    assert "Other story" not in H.extract(f"<article><p>{PROSE}</p><ul>{links}</ul><p>{PROSE}</p></article>")
    assert "One link" in H.extract(f"<article><p>{PROSE}</p><p><a href='/m'>One link</a></p><p>{PROSE}</p></article>")


def test_very_many_open_elements_and_stray_ends():
    n = 100_000
    began = time.monotonic()
    assert H.extract("<div>x" * n).count("x") > 0
    assert H.extract("<span>" * n + "x" + "</b>" * n) == "x"
    assert time.monotonic() - began < 30
