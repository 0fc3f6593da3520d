import html
import itertools
import re

import numpy as np
import pytest

from conftest import SMALL_SF
from helpers import LONG, frame
from marquee.llm import html_extract
from marquee.llm.html_tree import Page
from marquee.llm.queries import QUERIES
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def model():
    return html_extract.fit(html_extract.labelled_pages())


def article_of(source):
    """Main text of the test pages, whose article element holds it."""
    inside = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", inside.replace("<br>", " ").replace("<b>", ""))
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_whole_table_equals_the_articles(spark):
    sources = {r.page_id: r for r in spark.read.parquet(f"{SMALL_SF}/pages.parquet").collect()}
    rows = QUERIES["op4_html_extraction"](spark, SMALL_SF).collect()
    assert len(rows) == len(sources)
    for r in rows:
        want = article_of(sources[r.page_id].html)
        assert (r.text, r.n_chars, r.url) == (want, len(want), sources[r.page_id].url)


def test_marginals_equal_enumeration(model):
    pages = [Page("<body><nav><a href=x>a b</a></nav><article><p>one two three four five</p></article></body>"), Page("")]
    forest = html_extract.Forest(pages, model.features)
    found, expected, total = forest.marginals(model.weights, model.pair)
    own, n = forest.own(model.weights), len(forest.parent)
    sums, z = np.zeros((n, 3)), 0.0
    for states in itertools.product(range(3), repeat=n):
        e = np.exp(sum(own[i, s] for i, s in enumerate(states)) + sum(
            model.pair[forest.kind[i], states[forest.parent[i]], states[i]] for i in range(n) if forest.parent[i] >= 0))
        z += e
        for i, s in enumerate(states):
            sums[i, s] += e
    assert np.allclose(found, sums / z) and np.isclose(total, np.log(z))
    assert np.isclose(expected.sum(), (forest.parent >= 0).sum())


def test_labelled_pages_are_told_apart(model):
    pages = [Page(s) for s in html_extract.labelled_pages()]
    for page, marginal in zip(pages, model.content(pages)):
        for tag, state, m in zip(page.tag, html_extract._states(page), marginal):
            assert tag != "#text" or (m > 0.5) == (state == 1)


UNSEEN = """<html><body><div class="site-header"><a href="/">Logo</a></div><div id="cookieConsent"><p>We use cookies to make this
site work well for you, read more in our policy.</p></div><ul class="nav-menu"><li><a href=1>One</a><li><a href=2>Two</a></ul>
<div class="entry-content"><h1>A &lt;title&gt; &amp; more</h1><p>The first   paragraph is long enough<br>to be
taken for what it&nbsp;is.</p><div class="ad-slot"><p>Buy this thing now, it is the best thing ever made!</p></div><p>Short.</p>
<script>var x = "<p>no</p>";</script><style>p{}</style></div><div class="commentList"><div class="comment"><p>I like this text a
lot, and I say so in many words.</p></div></div><form action=x><p>Your name here please</p></form><div class="sidebar-widget"><p>
Something else that has nothing to do with it.</p></div><footer>&copy; all of us</footer></body></html>"""


def test_unseen_page(model):
    assert html_extract.extract(model, [UNSEEN]) == [
        "A <title> & more\n\nThe first paragraph is long enough to be taken for what it is.\n\nShort."]


@pytest.mark.parametrize("source", ["", "<", "<p", "</p></div>", "<!-- x", "<script>", "<a href='x", "<p>" * 3000, "<div>" * 3000,
                                    "&#0;&bogus;&#x110000;", "<table><tr><td>x<tr><td>y</table>", "<![CDATA[x"])
def test_broken_html_is_taken(model, source):
    assert isinstance(html_extract.extract(model, [source])[0], str)


def test_awkward_rows(spark, model):
    rows = [(1, None), (2, ""), (3, f"<article><p>{LONG}</p></article>"), (3, f"<article><p>{LONG}</p></article>"), (None, "<p>x")]
    df = frame(spark, rows, "page_id BIGINT, html STRING")
    texts = [r.text for r in df.withColumn("text", html_extract.extract_column(spark, model, F.col("html"))).collect()]
    assert texts[:4] == ["", "", LONG.strip(), LONG.strip()]
    assert df.limit(0).withColumn("text", html_extract.extract_column(spark, model, F.col("html"))).count() == 0


def blocks(source):
    page = Page(source)
    return [x for x, tag in zip(page.text, page.tag) if tag == "#text"]


@pytest.mark.parametrize("inside", [
    "<svg width='1'/>", "<svg/>", "<SVG viewBox='0 0 1 1'/>", "<math/>", "<svg><g><path d='m'/></g></svg>",
    "<svg><svg><path d='m'/></svg><text>no</text></svg>", "<svg><title>no</svg>", "<svg><title/><style/><g/></svg>",
    "<svg><foreignObject><div>no</div></foreignObject></svg>", "<object><object>no</object>no</object>",
    "<select><option>no<option>no</select>", "<video src=x><p>no</p></video>", "<template><p>no<template>no</template>no</template>",
    "<svg><path d='m'>", "<object data=x>", "<video src=x>", "<video src=x />", "<audio src=x>", "<canvas>", "<select>", "<svg><title/>",
    "<svg><style><path d='m'/>", "<!-- <svg> -->", "<script>'<svg>'</script>"])
def test_nothing_but_the_element_is_skipped(model, inside):
    assert blocks(f"<article><p>one {inside} two<p>three</p></article><p>four</p>") == ["one two", "three", "four"]
    # Neither an end tag further on nor one of an element around it makes an open element longer.
    more = "<div><svg><g></g></svg><object></object><video></video><audio></audio><canvas></canvas><select></select></div>"
    assert blocks(f"<article><div>one {inside}</div><p>two</p></article>{more}<p>three</p>") == ["one", "two", "three"]
    words = " ".join(["several words of the article stand here"] * 8)
    page = f"<body><nav><a href=/>Home</a></nav><article><h1>A title</h1><p>{words}</p>{inside}<p>{words}</p></article></body>"
    assert html_extract.extract(model, [page]) == [f"A title\n\n{words}\n\n{words}"]


def test_text_of_formulas_is_kept():
    formula = ("<math><semantics><mrow><mi>x</mi><mo>&lt;</mo><mn>2</mn><mspace/></mrow><annotation encoding='tex'>x \\lt 2"
               "</annotation></semantics></math>")
    assert blocks(f"<p>Let {formula} be so.</p><p>More</p>") == ["Let x<2 be so.", "More"]
    assert blocks("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math>") == ["1 2"]


def test_icons_leave_links_and_paragraphs_as_they_are():
    page = Page("<p><a href=/x>go <svg><path d='m'/></svg> on</a> now</p>")
    assert (page.text[-1], page.linked[-1]) == ("go on now", 4)
    assert blocks("<svg><path d='m'><p>left</p></svg><p>right</p>") == ["left", "right"]


def test_many_open_elements_take_linear_time():
    for name in ("video", "svg", "select", "object"):
        assert blocks(f"<div><p>a</p>{f'<{name}>' * 30_000}<p>b</p></div>") == ["a", "b"]


@pytest.mark.parametrize("tag", ["<p><a href=/it's>", "<p don't>", "<p title=it's class=a'b>", "<p class='a\"b'>", '<p class="it\'s">',
                                 "<p a = 'x>y' b>", "<p data-x==\"'>", "<p =\">", '<p "quoted">', "<p title=>"])
def test_quotes_open_a_value_only_after_an_equals_sign(tag):
    assert blocks(f"<div><p>one</p>{tag}two</p><p>it's three</p></div>") == ["one", "two", "it's three"]


def test_an_unclosed_quote_ends_with_its_tag():
    assert blocks('<p>one</p><p class="a>two</p><p>three</p>') == ["one", "two", "three"]
    assert blocks("<p>one</p><p class='a>two") == ["one", "two"]
    # Closed further on, it holds what stands before the closing quote, as in a browser.
    assert blocks('<p>one</p><p class="a>two</p><p id="b">three</p>') == ["one", "three"]


def test_apostrophes_leave_the_article_whole(model):
    words = " ".join(["several words of the article stand here"] * 8)
    page = f"<body><nav><a href=/>Home</a></nav><article><h1>A title</h1><p>{words}</p><p><a href=/it's>It's</a> {words}</p>" \
           f"<p don't>Don't {words}</p></article></body>"
    assert html_extract.extract(model, [page]) == [f"A title\n\n{words}\n\nIt's {words}\n\nDon't {words}"]


def test_attributes_of_unquoted_values():
    from marquee.llm.html_tree import attributes
    assert attributes(" class=a'b ID = 'x y' data-z=/it's/ hidden") == {
        "class": "a'b", "id": "x y", "data-z": "/it's/", "hidden": ""}


def test_a_page_without_tags_is_its_text(model):
    assert html_extract.extract(model, ["Just some  text &amp; more\nof it."]) == ["Just some text & more of it."]
    assert html_extract.extract(model, ["a < b", " \n "]) == ["a < b", ""]


def test_empty_table_and_clashing_columns(spark, model):
    table = frame(spark, [(1, "<article><p>one</p></article>", "x", 2)], "page_id BIGINT, html STRING, text_ STRING, tag INT")
    found = table.withColumn("found", html_extract.extract_column(spark, model, F.col("html")))
    assert found.columns == ["page_id", "html", "text_", "tag", "found"] and found.limit(0).count() == 0


#: Class names of a page in other languages: head, content, side column, comments, one comment, advert, foot.
LAYOUTS = {
    "german": "kopfzeile inhalt seitenleiste leserkommentare kommentar werbung fusszeile",
    "french": "entete contenu laterale commentaires commentaire publicite pied-page",
    "spanish": "cabecera contenido lateral comentarios comentario publicidad pied",
}


@pytest.mark.parametrize("language", list(LAYOUTS))
def test_layouts_named_in_other_languages(model, language):
    head, content, side, comments, comment, advert, foot = LAYOUTS[language].split()
    paragraph = "The river rises in the hills and flows through three valleys before it meets the sea, as old maps show."
    page = (f'<body><div class="{head}"><ul><li><a href=/>Start</a><li><a href=/k>Contact</a></ul></div>'
            f'<div class="{content}"><h1>The river</h1><p>{paragraph}</p><p>{paragraph}</p>'
            f'<div class="{advert}"><p>Buy the new boat, now for less than ever before!</p></div><p>{paragraph}</p></div>'
            f'<div class="{side}"><h3>More</h3><ul><li><a href=/1>The river in winter</a><li><a href=/2>Bridges</a></ul></div>'
            f'<div class="{comments}"><h3>Readers</h3><div class="{comment}"><b>Hans</b><p>That was a fine text, many thanks '
            f'for writing it down.</p></div><div class="{comment}"><b>Eva</b><p>I do not agree with that.</p></div></div>'
            f'<div class="{foot}">2024 Publisher</div></body>')
    assert html_extract.extract(model, [page]) == ["\n\n".join(["The river", *[paragraph] * 3])]
