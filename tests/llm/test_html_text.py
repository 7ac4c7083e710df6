"""Main text extraction on small pages whose article is known."""

import html
import re

import pytest

from surveywave.llm.html_text import extract_main_text, main_text

LONG = "This sentence is long enough to weigh as article text and it goes on for a while."
PAGES = {
    "plain article": (f"<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>{LONG}</p><p>Of.</p></article><footer>c</footer></body>", ["T", LONG, "Of."]),
    "no semantic tags": (f"<div class=menu><a href=1>a</a></div><div id=main-content><h2>T</h2><p>{LONG}</p><p>x</p><p>{LONG}</p></div>"
                         f"<div class='sidebar'><p>{LONG}</p></div>", ["T", LONG, "x", LONG]),
    "comments, forms, notices": (f"<main><p>{LONG}</p><div class='cookie-notice'>{LONG}</div><form><p>{LONG}</p></form><p>end</p>"
                                 f"<section id=comments><p>{LONG}</p></section></main>", [LONG, "end"]),
    "scripts and styles": (f"<script>var t='</p><p>no';</script><style>p{{}}</style><article><p>{LONG}<script>x()</script></p><!-- <p>no</p> --></article>", [LONG]),
    "references and white space": ("<article><p>a &amp; b&nbsp;&#233;\n\t c  &lt;p&gt;</p><p>d<b>e</b> f</p></article>", ["a & b é c <p>", "de f"]),
    "unclosed tags": (f"<article><h1>T</h1><p><b>{LONG}<br><p>two<p>three<ul><li>four<li>five</ul></article><footer>no", ["T", LONG, "two", "three", "four", "five"]),
    "stray ends": (f"</div><article></b></p><p>{LONG}</i></p></article></section>", [LONG]),
    "a wrapper named after its surroundings": (f"<div class='has-sidebar'><p>{LONG}</p><p>y</p></div>", [LONG, "y"]),
    "header inside and outside": (f"<header><p>site</p></header><article><header><h1>T</h1></header><p>{LONG}</p></article>", ["T", LONG]),
    "attributes with brackets": (f"<article><p title='a > b' data-x=\"</p>\">{LONG}</p></article>", [LONG]),
    "boilerplate inside the article": (
        f"<article><p>{LONG}</p><div class=notice>{LONG}</div><aside>{LONG}</aside><div class='alert warning'>{LONG}</div>"
        f"<div class='ad'>{LONG}</div><ul class='reader-comments'><li>{LONG}</li></ul><p>end</p></article>", [LONG, "end"]),
    "hidden": (f"<article><p>{LONG}</p><p hidden>no</p><p style='display: none'>no</p></article>", [LONG]),
    "table": (f"<article><p>{LONG}</p><table><tr><td>1<td>2<tr><td>3</table></article>", [LONG, "1", "2", "3"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_known_articles(name):
    page, blocks = PAGES[name]
    assert main_text(page) == "\n".join(blocks)


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<script>", "<div><nav>menu</nav></div>", "</p>" * 50])
def test_pages_without_text(page):
    assert main_text(page).strip("<") == ""


def test_long_and_deep_pages_are_linear():
    assert main_text("<div>" * 20_000 + LONG) == LONG
    assert len(main_text("<article>" + f"<p>{LONG}" * 20_000)) == 20_000 * (len(LONG) + 1) - 1
    assert main_text("<a =\"" * 20_000) == ""


def test_given_pages_against_their_template(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r.page_id: (r.text, r.n_chars) for r in extract_main_text(pages).collect()}
    assert len(out) == pages.count()
    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        flat = re.sub(r"</?[a-zA-Z][^>]*>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", "\0", article))
        text = "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in flat.split("\0")) if b)
        assert out[row.page_id] == (text, len(text))


def test_rows_and_columns(spark):
    schema = "page_id long, url string, html string, text string, _row int"
    rows = [(1, "u", f"<p>{LONG}</p>", "clash", 1), (1, "u", f"<p>{LONG}</p>", "clash", 1), (None, None, None, None, None)]
    out = extract_main_text(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "_row", "text", "n_chars"]
    assert sorted(map(str, ((r.page_id, r.text, r.n_chars) for r in out.collect()))) == sorted(map(str, [(1, LONG, len(LONG))] * 2 + [(None, "", 0)]))
    assert extract_main_text(spark.createDataFrame([], schema)).count() == 0


NAMED = {
    "headings and paragraphs": (f"<article><h2 id=discussion>D</h2><p class=share-price>{LONG}</p><p id=social>x</p></article>", ["D", LONG, "x"]),
    "sections of a paper": (f"<article><p>{LONG}</p><section id=related-work><h2>R</h2><p>{LONG}</p></section><div id=social-impact><p>short</p></div>"
                            f"<section id='discussion'><p>{LONG}</p></section></article>", [LONG, "R", LONG, "short", LONG]),
    "sections without an article": (f"<body><div><h1>T</h1><p>{LONG}</p><section id=discussion><h2>D</h2><p>{LONG}</p></section></div></body>", ["T", LONG, "D", LONG]),
    "a wrapper": (f"<div class=page-with-sidebar><p>{LONG}</p><p>{LONG}</p></div>", [LONG, LONG]),
    "a wrapper that holds most": (f"<div class=layout-sidebar><p>{LONG}</p><p>{LONG}</p></div><div>x</div>", [LONG, LONG]),
    "other attributes": (f"<article><div data-id=comments data-role=navigation title='a id=ad b'><p>{LONG}</p></div></article>", [LONG]),
    "link lists by topic": (f"<article><p>{LONG}</p><div class=related><a href=1>one</a> <a href=2>two</a></div></article>", [LONG]),
    "comments beside an article": (f"<article><p>{LONG}</p></article><div id=comments><p>{LONG}</p><p>{LONG}</p></div>", [LONG]),
    "long comments inside": (f"<article><p>{LONG}</p><div id=comments><p>{LONG}</p><p>{LONG}</p></div></article>", [LONG]),
}


@pytest.mark.parametrize("name", NAMED)
def test_names_are_evidence_only(name):
    page, blocks = NAMED[name]
    assert main_text(page) == "\n".join(blocks)
