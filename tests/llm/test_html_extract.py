import html
import re

import pytest

from quarry.llm import html_extract as X
from quarry.llm.common import table
from tests.conftest import SF01

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style></head><body>
<div class="header"><a href="/">Home</a> <a href="/x">News</a></div><nav><ul><li>one</li></ul></nav>
%s<footer>&copy; all rights</footer></body></html>"""


@pytest.fixture(scope="module")
def weights(spark):
    return X.fit_pages(table(spark, SF01, "pages"))


def article(page):
    """The article of a generated page by its markup alone."""
    body = page.split("<article>", 1)[1].split("</article>")[0]
    blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    clean = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def test_given_pages(spark):
    pages = {r.page_id: r for r in table(spark, SF01, "pages").collect()}
    for r in X.op6_html_extraction(table(spark, SF01, "pages")).collect():
        assert r.text == article(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("body,text", [
    ("<article><h1>A &lt;title&gt;</h1><p>Some <b>bold</b>ness\n here</p></article>",
     "A <title>\n\nSome boldness here"),
    ("<main><p>first part of it all</p><div class='ad'>buy this now please</div>"
     "<p>second part of it</p><form>mail <input></form></main><aside>other things</aside>",
     "first part of it all\n\nsecond part of it"),
    ("<article><p>one &amp; two words here</p><script>var t = '</p>';</script><p>three&nbsp;four"
     "</article><section class='comments'><p>nice post you wrote there</p></section>",
     "one & two words here\n\nthree four"),
    ("<article><p>an unclosed article goes on <!-- <p>hidden</p> --> to the end of it",
     "an unclosed article goes on to the end of it"),
])
def test_side_matter_is_left_out(weights, body, text):
    assert X.extract(PAGE % body, weights) == text


def test_pages_without_article(weights):
    page = PAGE % ("<div class='post'><p>plain page of words that go on</p><p>and on they go</p></div>"
                   "<div id='comments'><p>what a page</p></div>")
    assert X.extract(page, weights) == "plain page of words that go on\n\nand on they go"


WORDS = "<p>first words of the whole story</p><p>and the rest of it</p>"


@pytest.mark.parametrize("body", [
    "<div class='site has-sidebar'><article>%s</article></div>",
    "<div class='no-sidebar'><div class='page-with-header'><main>%s</main></div></div>",
    "<form id='aspnetForm'><article>%s</article></form>",
    "<main><div class='has-sidebar'><article>%s</article></div></main>",
    "<form action='x'><div class='post'>%s</div></form>",
    "<div class='site has-sidebar'><div class='post'>%s</div><div id='comments'><p>what a page</p></div></div>",
    "<div class='has-sidebar'><article>%s<div class='ad'>buy it</div></article></div>",
    "<article>%s</article><div class='related'><article><p>other stories to read now</p></article></div>",
    "".join(f"<div class='elementor-element-{k} elementor-widget-text'>{p}</p></div>"
            for k, p in enumerate(WORDS.split("</p>")[:-1])),
])
def test_wrappers_are_not_side_matter(weights, body):
    page = PAGE % (body % WORDS if "%s" in body else body)
    assert X.extract(page, weights) == "first words of the whole story\n\nand the rest of it"
    assert X.extract(page.replace("<body>", "<body class='has-sidebar'>"), {}) == X.extract(page, {}) != ""


def test_many_comments_are_still_side_matter(weights):
    page = PAGE % ("<div class='post'>%s</div><div id='comments'>%s</div>" % (WORDS, "<p>what a page</p>" * 90))
    assert X.extract(page, weights) == "first words of the whole story\n\nand the rest of it"


@pytest.mark.parametrize("scores", [[], [-1, -2], [1, -2, 3, -1, 2, -9, 3], [2, -1, -1, 2]])
def test_linear_scan_finds_the_maximum(scores):
    start, end = X.best_region(scores)
    most = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)),
               default=0)
    assert sum(scores[start:end]) == max(most, 0)


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (None, "u", "<p>x <b"), (3, "u", "<"),
            (4, "u", "<article><p>" + "word " * 50_000), (5, "u", "<nav>a b c</nav>")]
    from pyspark.sql import functions as F
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("clash"))
    out = {(r.page_id, r.n_chars) for r in X.op6_html_extraction(pages).collect()}
    assert {(1, 0), (2, 0), (4, 249_999), (5, 0)} <= out
    assert X.op6_html_extraction(pages).count() == len(rows)
    assert X.op6_html_extraction(spark.createDataFrame([], SCHEMA)).count() == 0
