"""Scalar functions: URLs, links, titles, popularity, images, text."""
from urllib.parse import urljoin

from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import text as TX
from quarry.functions import urls as U
from quarry.functions.porter import stem_sql, stem_table
from tests.plain_porter import stem
from quarry.operators import links as L

BASES = ["http://h/a/b?x#y", "http://h", "http://h/", "https://h/a/b/", "http://h/a/b/c/d;p?q"]
HREFS = ["/c", "c", "../c", "?q", "#f", "//k/d", "https://z/", "./c", "../../c",
         "../../../../g", "/a/./b/../c", "g/./h", "g/..", "..", ".", " ", "g?y#s", "./",
         "../", "g;x", "g//h", "/../c", "a/../../b?z#w", "mailto:x@y"]


def test_resolve_matches_urljoin(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "b string, h string")
    got = df.select("b", "h", U.resolve(F.col("b"), F.col("h")).alias("r")).collect()
    bad = [(r.b, r.h, r.r, urljoin(r.b, r.h)) for r in got if r.r != urljoin(r.b, r.h)]
    assert not bad


def test_strict_link_filter(spark):
    hrefs = ["/wiki/Special:Random", "#top", "a#b", "Category:X", "/x:Citation", "", None, "/ok"]
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs if h is not None) + "<a name=n>y</a>"
    pages = spark.createDataFrame([(1, "http://h/p", html)], "page_id long, url string, html string")
    strict = [r.href for r in L.page_links(pages, strict=True).collect()]
    loose = [r.href for r in L.page_links(pages, strict=False).collect()]
    assert strict == ["/ok"]
    assert loose == ["/wiki/Special:Random", "#top", "a#b", "Category:X", "/x:Citation", "/ok"]


def test_anchor_quotes_and_entities(spark):
    html = """<a href='/s'>1</a><A HREF=/u>2</A><a class="c" href="/q?a=1&amp;b=2">3</a>"""
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(H.anchor_hrefs(F.col("html"))).first()[0] == ["/s", "/u", "/q?a=1&b=2"]


def test_titles(spark):
    cases = [
        ("Name - MyAnimeList.net", "name", "name"),
        ("Name (TV) | Other - MyAnimeList.net", "name (tv) | other", "name"),
        ("Name (A) (B)", "name (a) (b)", "name"),
        ("  Plain &amp; Simple \n", "plain & simple", "plain & simple"),
    ]
    rows = [(f"<html><head><title>{t}</title></head></html>",) for t, _, _ in cases]
    df = spark.createDataFrame(rows, "html string")
    got = df.select(H.index_title(F.col("html")).alias("i"),
                    H.clean_title(H.raw_title(F.col("html"))).alias("c")).collect()
    assert [(r.i, r.c) for r in got] == [(i, c) for _, i, c in cases]


def test_popularity_weight(spark):
    rows = ['<span class="numbers popularity">Popularity <strong>#12</strong></span>',
            "<p>none</p>",
            '<span class="numbers popularity">Popularity <strong>#N/A</strong></span>']
    df = spark.createDataFrame([(r,) for r in rows], "html string")
    got = [r[0] for r in df.select(H.title_weight(F.col("html"))).collect()]
    assert got == [99999 - 12, 0, 0]


def test_og_image(spark):
    rows = ['<meta property="og:image" content="http://i/x.jpg">',
            '<meta content="http://i/y.jpg" property="og:image">',
            '<meta property="og:title" content="t">']
    df = spark.createDataFrame([(r,) for r in rows], "html string")
    assert [r[0] for r in df.select(H.og_image(F.col("html"))).collect()] == \
        ["http://i/x.jpg", "http://i/y.jpg", None]


def test_ports(spark):
    urls = ["http://h:80/a", "http://h:65535/", "http://h:65536/", "http://h:abc/", "http://h/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = df.select(U.port(F.col("url")).alias("p"), U.port_ok(F.col("url")).alias("ok"),
                    U.host(F.col("url")).alias("h")).collect()
    assert [(r.p, r.ok) for r in got] == [(80, True), (65535, True), (None, False),
                                          (None, False), (None, True)]
    assert {r.h for r in got} == {"h"}


def test_visible_text(spark):
    html = ("<html><head><style>p{x}</style><script>var a='<b>';</script></head>"
            "<body><!-- hidden --><p>Hello&nbsp;<b>world</b></p>\n<p>&lt;ok&gt; &amp;amp;</p></body></html>")
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(H.visible_text(F.col("html"))).first()[0] == "Hello world <ok> &amp;"


def test_tokenisers(spark):
    df = spark.createDataFrame([("Magi: The Labyrinth of Magic, aharen-san wa 1.5 x_y!",)], "t string")
    r = df.select(TX.punct_tokens(F.col("t")).alias("p"), TX.word_tokens(F.col("t")).alias("w"),
                  TX.content_tokens(F.col("t")).alias("c")).first()
    assert r.p == ["magi", "the", "labyrinth", "of", "magic", "aharensan", "wa", "15", "xy"]
    assert r.w == ["magi", "the", "labyrinth", "of", "magic", "aharen", "san", "wa", "1.5", "x_y"]
    assert r.c == ["magi", "labyrinth", "magic", "aharen", "san", "wa", "1.5", "x_y"]


def test_porter():
    pairs = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "motoring": "motor",
             "hopping": "hop", "filing": "file", "happy": "happi", "relational": "relat",
             "generalization": "gener", "adjustment": "adjust", "controll": "control",
             "is": "is", "rate": "rate"}
    assert {w: stem(w) for w in pairs} == pairs


def test_doc_ids_collisions(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/"), (2, "http://b/"), (3, "http://a/"), (4, "http://c/")],
        "page_id long, url string").withColumn("html", F.lit(""))
    forced = L.doc_ids(pages, digest=lambda u: F.when(u.isin("http://a/", "http://b/"), F.lit("h"))
                       .otherwise(F.sha2(u, 256)))
    got = {r.url: r.doc_id for r in forced.collect()}
    assert got["http://a/"] == "h.html" and got["http://b/"] == "h_0.html"
    assert got["http://c/"].endswith(".html") and len(got) == 3


def test_stems_of_columns(spark):
    """The expressions equal the algorithm on suffixes, runs of y and odd words,
    on Spark and as SQL text."""
    import itertools
    import random

    import duckdb
    rng = random.Random(7)
    ends = ["", "s", "ed", "ing", "eed", "y", "e", "ll", "ational", "ization", "iveness", "icate", "ness",
            "ement", "sion", "tion", "ous", "ies", "sses", "at", "bl", "iz", "able", "yy", "ion"]
    words = {"".join(rng.choices("aeybclstwx", k=rng.randint(1, 6))) + e for _ in range(1500) for e in ends}
    words |= {"".join(p) for n in (1, 2, 3, 4) for p in itertools.product("ayb", repeat=n)}
    words |= {"naïve", "été", "中文", "a.b", "x1ing", "", "hopping", "relational", "yes", "sky", "syzygy"}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "term string")
    want = {w: stem(w) for w in words}
    assert {r.term: r.stem for r in stem_table(df).collect()} == want
    given = df.toPandas()  # noqa: F841  (read by the SQL)
    assert dict(duckdb.sql(stem_sql("SELECT term FROM given")).fetchall()) == want
