"""Segments, deletions and merges against an index built anew."""
import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import index as IX
from quarry.operators import search as SE
from quarry.operators import stored_index as SI
from tests.conftest import SF001


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same(got, want):
    assert rows(got.postings.select("field", "term", "url", "tf", "len")) == \
        rows(want.postings.select("field", "term", "url", "tf", "len"))
    assert rows(got.doc_freq.select("field", "term", "df")) == rows(want.doc_freq.select("field", "term", "df"))
    assert rows(got.field_stats) == rows(want.field_stats)
    assert rows(got.docs.select("url", "title")) == rows(want.docs.select("url", "title"))


@pytest.fixture()
def pages(spark):
    return spark.read.parquet(f"{SF001}/pages.parquet").where("page_id < 60")


def test_segments_equal_a_rebuild(spark, pages, tmp_dir):
    path = os.path.join(tmp_dir, "it's an index")
    SI.create_index(path, pages.where("page_id < 20"), stem=False, buckets=4)
    same(SI.open_index(spark, path), IX.build_index(pages.where("page_id < 20"), stem=False))
    assert SI.add_pages(path, pages.where("page_id >= 10 and page_id < 40")) == 2
    assert SI.add_pages(path, pages.where("page_id >= 40")) == 3
    same(SI.open_index(spark, path), IX.build_index(pages, stem=False))
    gone = pages.where("page_id % 7 = 3").select("url").unionByName(
        spark.createDataFrame([("http://unknown/",)], "url string"))
    SI.delete_urls(path, gone)
    same(SI.open_index(spark, path), IX.build_index(pages.where("page_id % 7 <> 3"), stem=False))
    SI.add_pages(path, pages.where("page_id % 14 = 3"))  # some come back
    left = pages.where("page_id % 7 <> 3 or page_id % 14 = 3")
    want = IX.build_index(left, stem=False)
    same(SI.open_index(spark, path), want)
    SI.delete_urls(path, pages.where("page_id = 17").select("url"))
    SI.add_pages(path, pages.where("page_id = 17"))
    assert SI.merge_segments(path, spark) == 8
    SI.remove_merged(path, spark)
    kept = [f for f in os.listdir(os.path.join(path, "postings")) if f.startswith("segment")]
    assert kept == ["segment=8"]
    same(SI.open_index(spark, path), want)


def test_uncommitted_segment_is_not_read(spark, pages, tmp_dir):
    path = os.path.join(tmp_dir, "ix")
    SI.create_index(path, pages.where("page_id < 10"), stem=False, buckets=4)
    half = IX.build_index(pages.where("page_id between 10 and 30"), stem=False)
    SI._write(spark, path, "postings", half.postings, 2, 4)  # the writer dies here
    same(SI.open_index(spark, path), IX.build_index(pages.where("page_id < 10"), stem=False))
    SI.add_pages(path, pages.where("page_id >= 10"))
    same(SI.open_index(spark, path), IX.build_index(pages, stem=False))


def test_reopened_by_another_session(spark, pages, tmp_dir):
    path = os.path.join(tmp_dir, "ix")
    SI.create_index(path, pages, stem=False, buckets=4)
    for kind in SI.TABLES:  # as a session that never saw the folder
        spark.sql(f"DROP TABLE {SI._name(path, kind)}")
    same(SI.open_index(spark, path), IX.build_index(pages, stem=False))


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_search_plan_reads_buckets_and_no_pages(spark, pages, tmp_dir):
    path = os.path.join(tmp_dir, "ix")
    SI.create_index(path, pages.where("page_id < 30"), stem=False, buckets=4)
    SI.add_pages(path, pages.where("page_id >= 30"))
    ix = SI.open_index(spark, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        queries = spark.createDataFrame([(1, "the"), (2, "a b")], "query_id long, query string")
        qterms = SE.analyze_groups(SE.title_queries(queries), stem=False, dedup_groups=False)
        plan = plan_of(SE.top_hits(SE.score(SE.match_groups(qterms, ix), "bm25"), 10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "html" not in plan
    tree, *nodes = plan.split("\n\n")
    scans = [p for p in nodes if "Scan parquet" in p and "postings" in p]
    assert len(scans) == 2 and all("SelectedBucketsCount: 4 out of 4" in p for p in scans)
    # from a postings scan up to its join there is no exchange
    lines = [(len(line) - len(line.lstrip(" :+-")), line) for line in tree.splitlines()]
    found = [i for i, (_, line) in enumerate(lines) if "Scan parquet" in line and "postings" in line]
    assert len(found) == 2
    for i in found:
        depth, parents = lines[i][0], []
        for d, line in lines[:i][::-1]:
            if d < depth:
                depth = d
                parents.append(line)
        join = next(k for k, line in enumerate(parents) if "Join" in line)
        assert not any("Exchange" in line for line in parents[:join]), tree


def test_search_of_many_segments(spark, pages, tmp_dir):
    path = os.path.join(tmp_dir, "ix")
    SI.create_index(path, pages.where("page_id < 30"), stem=False, buckets=4)
    SI.add_pages(path, pages.where("page_id >= 30"))
    queries = pages.select(F.col("page_id").alias("query_id"), F.lit("the").alias("query"))
    got = SE.search(queries, SI.open_index(spark, path), "bm25", stem=False)
    assert rows(got) == rows(SE.search(queries, IX.build_index(pages, stem=False), "bm25", stem=False))


def test_repeated_rows_count_once(spark, pages):
    again = pages.withColumn("page_id", F.col("page_id") + 1000)
    other = pages.limit(1).withColumn("page_id", F.lit(None).cast("long")).withColumn("url", F.lit("http://null.id/"))
    want = IX.build_index(pages.unionByName(other), stem=False)
    same(IX.build_index(pages.unionByName(pages).unionByName(again).unionByName(other), stem=False), want)


def test_text_is_tokenised_once(spark):
    """The text of a page is worked out once: neither the filter that a
    generator brings nor the length repeats it."""
    from quarry.operators import index as IX
    pages = spark.createDataFrame([(1, "u", "<title>a &amp; b</title><p>red &lt; red</p>"), (2, "v", None)],
                                  "page_id long, url string, html string")
    for field in ("title", "content"):
        terms = IX.field_terms(IX.page_fields(pages), (field,))
        plan = terms._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_extract_all") == 1
    got = sorted((r.field, r.url, r.term, r.len) for r in IX.field_terms(IX.page_fields(pages)).collect())
    assert got == [("content", "u", "red", 2), ("content", "u", "red", 2), ("title", "u", "a", 2), ("title", "u", "b", 2)]
