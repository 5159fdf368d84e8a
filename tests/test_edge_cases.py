"""Hand-written expected values for inputs that the generated tables lack."""
import os

import pytest
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import text as TX
from quarry.operators import index as IX
from quarry.operators import pagerank as PR
from quarry.operators import suggest as SG
from quarry.plans import logs
from quarry.streaming import replay as RP


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x"))).first()[0]


@pytest.mark.parametrize("page,hrefs", [
    ('<a href="a b.html">', ["a b.html"]), ('<a href="/it\'s">', ["/it's"]),
    ("<a class=x href='q\"r'>", ['q"r']), ("<a href=/plain>", ["/plain"]),
    ('<!-- <a href="hidden"> --><a href="shown">', ["shown"]),
    ('<script>var t = \'<a href="no">\';</script><a href="?a=1&amp;b=2">', ["?a=1&b=2"]),
])
def test_hrefs(spark, page, hrefs):
    assert one(spark, page, H.anchor_hrefs) == hrefs


@pytest.mark.parametrize("text,plain", [
    ("It&#039;s &eacute;t&#233;", "It's été"), ("&#x1F600; &#xe9;", "😀 é"), ("&amp;lt;", "&lt;"),
    ("a & b &nosuch; &", "a & b &nosuch; &"), ("&#0;&#xD800;&#1114112;", "���"),
    ("&apos;&quot;&copy;&middot;", "'\"©·"), ("none", "none"), (None, None),
])
def test_character_references(spark, text, plain):
    assert one(spark, text, H.unescape) == plain


@pytest.mark.parametrize("text", ["a　b c\x85d\x1ce  f", "  x \n", " "])
def test_white_space_is_pythons(spark, text):
    assert one(spark, text, TX.punct_tokens) == text.split()
    assert one(spark, text, H.strip_ws) == text.strip()


def test_query_without_suggestion_stays(spark):
    q = spark.createDataFrame([(1, "zzzzzzzzzzzz qqqqqqqqqqq"), (2, "magi")], "query_id long, query string")
    entries = spark.createDataFrame([("magi", "magi", 1)], "key string, title string, weight int")
    rows = {(r.query_id, r.group_id, r.text) for r in SG.suggestion_groups(q, entries).collect()}
    assert rows == {(1, 0, "zzzzzzzzzzzz qqqqqqqqqqq"), (2, 0, "magi")}


def test_one_row_per_url(spark):
    pages = spark.createDataFrame([(2, "u", "<title>b b</title>"), (1, "u", "<title>a</title>"),
                                   (3, "v", "<title>c</title>")], "page_id long, url string, html string")
    ix = IX.build_index(pages, which=("title",))
    assert {(r.term, r.url, r.tf) for r in ix.postings.collect()} == {("a", "u", 1), ("c", "v", 1)}
    assert ix.field_stats.first().n_docs == 2


def test_pagerank_that_does_not_settle_is_an_error(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1), ("c", "a", 1)], "src string, dst string, n long")
    with pytest.raises(RuntimeError, match="max_iter"):
        PR.pagerank(edges, epsilon=1e-12, max_iter=2)


def test_invalid_page_request_shows_page_one(spark):
    rows = [(1, 7, "2024-01-01 00:00:00", "view", 55.0), (2, 7, "2024-01-01 00:00:01", "click", 0.0),
            (3, 7, "2024-01-01 00:00:02", "click", 0.0), (4, 7, "2024-01-01 00:00:03", "error", 0.0),
            (5, 7, "2024-01-01 00:00:04", "click", 0.0)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, value double")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.event_id: r.page_no for r in RP.page_replay(events).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 1, 5: 2}


def test_stream_replay_does_not_depend_on_the_arrow_batch(spark, tmp_dir):
    from tests.conftest import SF001
    events = (spark.read.parquet(f"{SF001}/events.parquet")
              .withColumn("ts", F.col("ts").cast("timestamp"))
              .withColumn("user_id", F.col("user_id") % 5).orderBy(F.xxhash64("event_id")))
    events.coalesce(1).write.parquet(f"{tmp_dir}/in")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "5")
    try:
        stream = spark.readStream.schema(events.schema).parquet(f"{tmp_dir}/in")
        q = (RP.page_replay_stream(stream).writeStream.format("parquet")
             .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(key, before)
    got = {r.event_id: r.page_no for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {r.event_id: r.page_no for r in RP.page_replay(events).collect()}


def test_ingestion_of_a_folder_table(spark, tmp_dir):
    from tests.conftest import SF001
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    pages.repartition(2).write.parquet(os.path.join(tmp_dir, "pages.parquet"))
    folder = {tuple(r) for r in logs.stream_ingest(spark, tmp_dir).collect()}
    assert folder and folder == {tuple(r) for r in logs.stream_ingest(spark, SF001).collect()}
