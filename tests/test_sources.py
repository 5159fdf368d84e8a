"""Sources and sinks (S1, S5-S9) and the index writer."""
import os

from pyspark.sql import functions as F

from quarry.operators import index as IX
from quarry.sources import files as FS


def test_html_folder_scan(spark, tmp_dir):
    d = os.path.join(tmp_dir, "raw")
    os.makedirs(d)
    for name, body in (("a.html", "<title>A</title>"), ("b.html", "<title>B</title>\n<p>x</p>")):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    url_map = spark.createDataFrame([("http://a/", "a.html"), ("http://b/", "b.html")],
                                    "url string, doc_id string")
    got = {r.url: r.html for r in FS.read_html_dir(spark, d, url_map).collect()}
    assert got == {"http://a/": "<title>A</title>", "http://b/": "<title>B</title>\n<p>x</p>"}


def test_round_trips(spark, tmp_dir):
    edges = spark.createDataFrame([("a", "b", 2), ("b", "a", 1)], FS.EDGES_SCHEMA)
    FS.write_edges(edges, os.path.join(tmp_dir, "e"))
    assert sorted(FS.read_edges(spark, os.path.join(tmp_dir, "e")).collect()) == sorted(edges.collect())
    FS.write_edges(edges, os.path.join(tmp_dir, "eb"), buckets=4)
    assert spark.table("quarry_edges").count() == 2
    ranks = spark.createDataFrame([("a", 0.5), ("b", 0.25)], FS.RANKS_SCHEMA)
    FS.write_ranks(ranks, os.path.join(tmp_dir, "r"))
    assert sorted(FS.read_ranks(spark, os.path.join(tmp_dir, "r")).collect()) == sorted(ranks.collect())
    titles = spark.createDataFrame([("naruto", 99987), ("bleach", 0)], FS.TITLES_SCHEMA)
    FS.write_titles(titles, os.path.join(tmp_dir, "t"))
    assert sorted(FS.read_titles(spark, os.path.join(tmp_dir, "t")).collect()) == sorted(titles.collect())
    syn = spark.createDataFrame([("t", 2, "y"), ("t", 1, "x"), ("u", 5, "z")], FS.SYNONYMS_SCHEMA)
    FS.write_synonyms(syn, os.path.join(tmp_dir, "s"))
    lists = {r.title: r.synonyms for r in FS.read_synonym_lists(spark, os.path.join(tmp_dir, "s")).collect()}
    assert lists == {"t": ["x", "y"], "u": ["z"]}
    img = spark.createDataFrame([("http://a/", "http://i/a.jpg")], FS.IMAGES_SCHEMA)
    FS.write_images(img, os.path.join(tmp_dir, "i"))
    assert FS.read_images(spark, os.path.join(tmp_dir, "i")).collect() == img.collect()


def test_write_index(spark, tmp_dir):
    pages = spark.createDataFrame([(1, "http://d/1", "<title>red blue</title><p>red</p>")],
                                  "page_id long, url string, html string")
    ix = IX.build_index(pages, stem=False)
    IX.write_index(ix, os.path.join(tmp_dir, "ix"), buckets=4)
    post = spark.table("quarry_postings")
    assert post.where(F.col("field") == "title").count() == 2
    # the page text includes the <title> text, as get_text() does
    assert post.where((F.col("field") == "content") & (F.col("term") == "red")).first().tf == 2


def test_wide_matrix(spark, tmp_dir):
    """20,000 columns plan and run: cells meet the header by place."""
    names = [f"http://h/{i}" for i in range(20_000)]
    names[3] = 'http://h/a,b'
    path = os.path.join(tmp_dir, "wide.csv")
    with open(path, "w") as f:
        f.write("," + ",\t".join(f'"{n}"' if "," in n else n for n in names) + "\n")
        for row in (1, 19_999):
            cells = ["0"] * 20_000
            cells[row], cells[3] = "2", "1"
            f.write(names[row] + "," + ", ".join(cells) + "\n")
    got = sorted(tuple(r) for r in FS.read_adjacency_csv(spark, path).collect())
    assert got == sorted([(names[1], names[1], 2.0), (names[1], "http://h/a,b", 1.0),
                          (names[19_999], names[19_999], 2.0), (names[19_999], "http://h/a,b", 1.0)])


def test_sitemaps(spark, tmp_dir):
    from quarry.operators import frontier as FR
    seeds = spark.createDataFrame([("a.org", 1, "http://a.org/1?x=1&y=<2>"), ("a.org", 2, "http://a.org/0"),
                                   ("b.org", 5, "http://b.org/é")], "domain string, seq int, url string")
    FS.write_sitemaps(seeds, os.path.join(tmp_dir, "maps"))
    os.makedirs(os.path.join(tmp_dir, "maps2"))
    with open(os.path.join(tmp_dir, "maps2", "c.xml"), "w") as f:
        f.write('<?xml version="1.0"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
                "<url><loc> http://c.org/2 </loc><lastmod>2024-01-01</lastmod></url>"
                "<url><priority>1</priority></url><url><loc>http://c.org/1</loc></url></urlset>")
    read = FS.read_sitemaps(spark, os.path.join(tmp_dir, "maps"))
    assert sorted(tuple(r) for r in read.collect()) == [
        ("a.org", 0, "http://a.org/1?x=1&y=<2>"), ("a.org", 1, "http://a.org/0"), ("b.org", 0, "http://b.org/é")]
    more = FS.read_sitemaps(spark, os.path.join(tmp_dir, "maps2"))
    assert [r.url for r in more.orderBy("seq").collect()] == ["http://c.org/2", "http://c.org/1"]
    cached = spark.createDataFrame([("a.org", 1, "http://a.org/kept")], "domain string, seq int, url string")
    lists = FR.seed_lists(cached, read.unionByName(more))
    assert sorted(r.url for r in lists.collect()) == [
        "http://a.org/kept", "http://b.org/é", "http://c.org/1", "http://c.org/2"]
