"""Main text of hand-made and generated pages."""

import html
import re

import pytest

from storemart.llm import html_main as H
from tests.conftest import SF_SMALL

FILL = "with quite enough words in it to look like the prose of an article"
PAGES = {
    "plain": ("<html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>"
              f"<article><h1>Head &amp; line</h1><p>First para {FILL}. <p>Second&nbsp;para   <b>bold\n<i>it</b></i> {FILL}.</p><p>Ok.</p></article>"
              "<footer>&copy; foot</footer></body></html>",
              ["Head & line", f"First para {FILL}.", f"Second para bold it {FILL}.", "Ok."]),
    "by names": (f"<body class='has-sidebar'><div id=header><h1>Site</h1></div><div class='cookie-notice'>We use cookies {FILL}</div>"
                 f"<div class=content><h1>Title</h1><p>One {FILL}.</p><div class='ad-box'>Buy {FILL}</div><ul><li>item one<li>item two</ul>"
                 f"<blockquote>Quoted {FILL}</blockquote></div><div class=sidebar><p>Side {FILL}</p></div><form><p>Your name {FILL}<input></form>"
                 f"<section id=comments><h2>Comments</h2><div class=comment><p>Reader {FILL}</p></div></section></body>",
                 ["Title", f"One {FILL}.", "item one", "item two", f"Quoted {FILL}"]),
    "by roles": (f"<main><p>Real {FILL}</p></main><div role=complementary><p>Not {FILL}</p></div><div hidden><p>Hidden {FILL}</p></div>"
                 f"<div style='display: none'>Gone {FILL}</div>", [f"Real {FILL}"]),
    "link runs": (f"<div><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul><p>Body {FILL} <a href=4>linked</a> too.</p></div>",
                  [f"Body {FILL} linked too."]),
    "unclosed": (f"<nav><a href=1>Menu<article><h1>Head</h1><p>Body {FILL}", ["Head", f"Body {FILL}"]),
    "article header": (f"<header>Site {FILL}</header><article><header><h1>Head</h1></header><p>Body {FILL}</p><footer>By me {FILL}</footer></article>",
                       ["Head", f"Body {FILL}"]),
    "comments as articles": (f"<article><p>Body {FILL}</p></article><article class=comment><p>Reader {FILL}</p></article>", [f"Body {FILL}"]),
    "names inside an article": (f"<article class='post comment-open'><h2 id=related-work>Related work</h2><p>Body {FILL}</p><section id=discussion><h2>Discussion</h2>"
                                f"<p class=notice>We argue {FILL}</p></section><div class=search-methods><p>Found {FILL}</p></div>"
                                f"<div class=ad-box>Buy {FILL}</div><div id=comments><p>Reader {FILL}</p></div></article>",
                                ["Related work", f"Body {FILL}", "Discussion", f"We argue {FILL}", f"Found {FILL}"]),
    "names around the text": (f"<div class=post-with-comments><h1 id=search>Head</h1><p>Body {FILL}</p></div><div class='page-menu wide'><p>More {FILL}</p><p>Most {FILL * 3}</p></div>"
                              f"<div class=top-menu>Menu</div><section id=discussion><p>Ends {FILL}</p></section><section id=comments><p>{FILL * 20}</p></section>",
                              ["Head", f"Body {FILL}", f"More {FILL}", f"Most {FILL * 3}", f"Ends {FILL}"]),
    "linked sources": (f"<main><p>Body {FILL}</p><h2>Sources</h2><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></main>",
                       [f"Body {FILL}", "Sources", "One", "Two", "Three"]),
    "text only": ("just text", ["just text"]),
    "nothing": ("", []),
    "markup only": ("<html><body><nav>menu</nav><script>x</script></body></html>", []),
    "broken": ("<p <b> a < b & c &#x41; &unknown; </p", ["a < b & c A &unknown;"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, want = PAGES[name]
    if name == "broken":
        assert H.blocks_of(page) is not None  # no crash, whatever the parser makes of it
        return
    assert H.blocks_of(page) == want


def test_short_paragraphs_of_a_long_article_stay():
    body = [f"Paragraph {i} {FILL}." if i % 5 else "No." for i in range(60)]
    assert H.blocks_of("<body><div><article>" + "".join(f"<p>{b}</p>" for b in body) + "</article></div></body>") == body


def test_sections_of_uneven_length_stay():
    short, long = [f"Short paragraph {i} of the summary, cut at sixty chars." for i in range(2)], [f"Long {i} " + FILL * 9 + "." for i in range(6)]
    sections = (f"<section><h2>{name}</h2>" + "".join(f"<p>{p}</p>" for p in body) + "</section>" for name, body in (("Summary", short), ("Details", long)))
    page = f"<body><nav><a href=1>Menu</a></nav><div class=hero><h1>Title</h1></div><div id=text>{''.join(sections)}</div><div class=footer>Foot</div></body>"
    assert H.blocks_of(page) == ["Title", "Summary", *short, "Details", *long]


def test_articles_of_uneven_length_stay():
    short, long = [f"Short {i}." for i in range(6)], [f"Long {i} " + FILL * 9 + "." for i in range(6)]
    first, second = ("".join(f"<p>{p}</p>" for p in body) for body in (short, long))
    assert H.blocks_of(f"<body><div>Site</div><div><article><h2>One</h2>{first}</article><article>{second}</article></div></body>") == ["One", *short, *long]


FOOTED = (f"<body><div class=links>About us Jobs</div><div class=text><p>Body {FILL * 2}</p><p>No.</p><p>More {FILL}</p><div>Caption</div></div>"
          f"<div>(c) 2024 Foo Inc</div></body>")


def test_link_rows_and_footers_without_a_telling_tag_go(monkeypatch):
    want = [f"Body {FILL * 2}", "No.", f"More {FILL}", "Caption"]
    assert H.blocks_of(FOOTED) == want
    # the ratios decide it: constant ones let everything through
    monkeypatch.setattr(H, "smoothed_ratios", lambda lines, group=None: __import__("numpy").ones(len(lines)))
    assert H.blocks_of(FOOTED) == ["About us Jobs", *want, "(c) 2024 Foo Inc"]


def test_script_inside_a_paragraph_does_not_split_it():
    assert H.blocks_of(f"<article><p>One <script>var a;</script>two {FILL}<style>p{{}}</style>.</p></article>") == [f"One two {FILL}."]


@pytest.mark.parametrize("part", ["<div>x", "<div>", "<a ", "<li><div>", "<span class=ad>y", "</p></foo>", "<!-- ", "<article>z", "<p <b>", "<a href='", "&amp", "<"])
def test_hostile_pages_take_linear_time(part):
    import time
    page = "<div>" * 2000 + part * (500_000 // len(part)) + "</x>" * 2000
    start = time.process_time()
    H.blocks_of(page)
    assert time.process_time() - start < 8


def test_generated_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for r in H.extract(pages, out="main").collect():
        inner = r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", inner))
        assert r["main"] == "\n\n".join(p for p in parts if p)


def test_odd_pages(spark):
    rows = [(1, None, None), (1, "u", ""), (None, None, "<p>" * 3000 + "deep " + "</div>" * 3000), (2, "u", "<p>" + "word " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' AS __whole")
    got = H.extract(df).collect()
    assert [r["text"][:4] for r in got] == ["", "", "deep", "word"] and got[3]["text"].count("word") == 200_000 and got[0]["__whole"] == "mine"
    assert H.extract(df.limit(0)).count() == 0
