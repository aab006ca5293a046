import html
import re

import pytest
from pyspark.sql import types as T

from netlens.llm.html_extract import blocks_of, content_scores, extract_main_text, main_text
from netlens.llm.queries import op1_html_extract
from tests.conftest import SF001

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href="/">Site</a><p>A slogan, with some words.</p></header>
<div class="main-menu"><a href="1">One</a><a href="2">Two</a></div>
<div id="cookieNotice"><p>We use cookies, many of them. Accept?</p></div>
<div class="content"><h1>Head &amp; line</h1><p>First   paragraph,&nbsp;with <b>bold</b> text.<p>Second &lt;one&gt;.
<ul><li>item<li>item two</ul><div class="ad-box">Buy it now, please. Cheap, cheap.</div>
<form><p>Write to us, now.</p></form><script>var x = "<p>no</p>";</script><!-- <p>no</p> -->
<p hidden>never shown, at all.</p><p>Last, a &#233; and a < b.</p></div>
<aside><p>Aside, a long text with commas, and with dots. More.</p></aside>
<section class="comments"><p>I like this text, very much indeed. Bravo!</p></section>
<div role="contentinfo">Imprint, and so on.</div></body></html>"""


def test_page():
    assert main_text(PAGE) == ("Head & line\n\nFirst paragraph, with bold text.\n\nSecond <one>.\n\n"
                               "item\n\nitem two\n\nLast, a é and a < b.")


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("just text", "just text"),
    ("<p>open <b>tag", "open tag"), ("<p>a</p></div></b><p>b", "a\n\nb"), ("<p>cut <a hre", "cut"),
    ("<script>x", ""), ("<nav>x</nav>", ""), ("<p>a<br>b</p>", "a b"),
    ("<article><p>x, y.</article><footer>z</footer>", "x, y.")])
def test_odd_pages(page, text):
    assert main_text(page) == text


BODY = "<h1>Title</h1>" + "<p>A running text, with commas, and full stops. And more of it.</p>" * 3


@pytest.mark.parametrize("page", [
    f'<div class="content right-sidebar">{BODY}</div>',
    f'<div class="page social"><article>{BODY}</article><div class="comments"><p>Me too, yes.</p></div></div>',
    f'<div id="page" class="nav-fixed"><div class="ad-box"><p>Buy it, now.</p></div><main>{BODY}</main></div>',
    f'<article>{BODY}</article><div class="related"><article><p>Read this, too.</p></article></div>',
    f'<div><div class="post">{BODY}</div></div><div class="comments">{"<p>I like it, a lot. Bravo!</p>" * 20}</div>'])
def test_names_of_what_wraps_the_article(page):
    assert main_text(page) == main_text(f"<div>{BODY}</div>") != ""


def test_names_of_sections():
    page = ('<article><h1>T</h1><p>First, a text.</p><h2 id="related-work">Related work</h2><p>Others, too.</p>'
            '<section id="social-impact"><p>It has some, yes.</p></section><div id="comments-on-x"><p>On x, well.</p></div>'
            '<section id="comments-area"><p>Bravo, I say.</p></section></article>')
    assert main_text(page).split("\n\n") == ["T", "First, a text.", "Related work", "Others, too.",
                                            "It has some, yes.", "On x, well."]


def test_text_outside_the_region():
    lead, more = "<p>The lead of it, in short, and no more.</p>", "<p>Running text, with commas, and stops. More.</p>" * 6
    assert main_text(f"<div><h1>Title</h1></div><div>{lead}</div><div>{more}</div>").startswith(
        "Title\n\nThe lead of it, in short, and no more.\n\nRunning")
    parts = main_text(f"<article><h2>One</h2>{more}</article><article><h2>Two</h2>{lead}<p>End</p></article>").split("\n\n")
    assert len(parts) == 10 and parts[0] == "One" and parts[-3:] == ["Two", "The lead of it, in short, and no more.", "End"]


def test_linked_items():
    items = "<ul>" + "".join(f"<li><a href={i}>Source {i}</a></li>" for i in range(3)) + "</ul>"
    text = "<p>Running text, with commas, and full stops. And more of it.</p>" * 4
    assert main_text(f"<div>{items}</div><article>{text}{items}</article>").count("Source") == 3


@pytest.mark.parametrize(("page", "text"), [
    ("<head><title>T</title><meta charset=x><p>a, b.", "a, b."), ("<html><head><title>T</title><body><p>a, b.", "a, b."),
    ("<head><noscript><style>p{}</style><body><p>a, b.", "a, b."), ("<head><title>T</title>a, b.", "a, b."),
    ('<div><svg width="1"/><p>a, b.</p></div>', "a, b."), ("<p>a, <svg><title/><path d=x></svg>b.", "a, b."),
    ("<svg><g><p>a, b.</p>", "a, b."), ("<math><mi>x<div>a, b.</div>", "a, b."), ('<iframe src="x"/><p>a, b.', "a, b."),
    ("<iframe src=x><p>a, b.</p><iframe>no</iframe>", "a, b."), ("<div><noscript>no</div><p>a, b.", "a, b."),
    ("<object data=x><p>a, b.", "a, b."), ("<select><option>no<option>no<p>a, b.", "a, b."),
    ("<p>a, <select><option>no</option></select>b.</p>", "a, b."), ("<p>a, <object><p>no</p></object>b.</p>", "a, b."),
    ("<noscript><p>no</p><div>no</div></noscript><p>a, b.", "a, b."), ("<svg><desc><p>no</p></desc></svg><p>a, b.", "a, b."),
    ("<template><div><template>no</template>no</div></template><p>a, b.", "a, b."), ("<canvas>no<p>a, b.", "a, b.")])
def test_odd_pages_of_skipped_elements(page, text):
    assert main_text(page) == text


def test_long_page():
    body = "".join(f"<p>Sentence {i}, of the text.</p>" for i in range(20000))
    out = main_text(f"<body><nav><a>x</a></nav><div>{body}</div></body>")
    assert out.count("\n\n") == 19999


def test_ratios_tell_text_from_menus():
    page = ("<div><ul>" + "<li><a href=x>Menu</a></li>" * 6 + "</ul></div><div>"
            + "<p>Running text, with commas, and full stops. And more of it.</p>" * 4 + "</div>")
    blocks = blocks_of(page)
    scores = content_scores(blocks)
    assert max(s for b, s in zip(blocks, scores, strict=True) if b.text == "Menu") < min(
        s for b, s in zip(blocks, scores, strict=True) if b.text != "Menu")
    assert "Menu" not in main_text(page)


def test_rows(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.StringType())])
    rows = [(1, "u", "<p>a 😀</p>", "x", "y"), (None, None, None, None, None), (1, "u", "<p>a 😀</p>", "x", "y")]
    out = extract_main_text(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(out.collect(), key=str) == sorted([(1, "u", "a 😀", 3), (None, None, "", 0),
                                                     (1, "u", "a 😀", 3)], key=str)
    assert extract_main_text(spark.createDataFrame([], schema)).count() == 0


def test_query_matches_the_article_element(spark):
    """The test pages keep their text in ``article``; the operator does not need to know."""
    def article(page):
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner)
        clean = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in parts]
        return "\n\n".join(x for x in clean if x)
    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    assert {r.page_id: r.text for r in op1_html_extract(spark, SF001).collect()} == want
