"""Matching, scoring, ranking, paging and merges."""
import math

from pyspark.sql import functions as F

from quarry.operators import index as IX
from quarry.operators import search as SE

DOCS = [
    (1, "http://d/1", "<title>red blue</title><p>red red apple</p>"),
    (2, "http://d/2", "<title>red green</title><p>blue sky</p>"),
    (3, "http://d/3", "<title>blue</title><p>green apple pie</p>"),
]


def _index(spark, stem=False):
    pages = spark.createDataFrame(DOCS, "page_id long, url string, html string")
    return IX.build_index(pages, stem=stem)


def _groups(spark, rows):
    return spark.createDataFrame(rows, "query_id long, group_id int, field string, text string")


def _hits(spark, rows, mode="bm25", ranks=None):
    ix = _index(spark)
    qt = SE.analyze_groups(_groups(spark, rows), stem=False)
    return {(r.query_id, r.url): r.score for r in SE.search_terms(qt, ix, mode, ranks).collect()}


def test_boolean_match_cases(spark):
    h = _hits(spark, [
        (1, 0, "title", "red"),                 # one word
        (2, 0, "title", "red blue"),            # two words, both in doc 1
        (3, 0, "title", "red purple"),          # one word unknown → no match
        (4, 0, "title", "red"), (4, 1, "title", "red green"),   # OR groups sharing a term
        (5, 0, "title", "purple"),              # unknown word
        (6, 0, "title", ""),                    # empty query
        (7, 0, "content", "apple"),             # content field
    ])
    assert {k for k in h if k[0] == 1} == {(1, "http://d/1"), (1, "http://d/2")}
    assert {k for k in h if k[0] == 2} == {(2, "http://d/1")}
    assert not [k for k in h if k[0] in (3, 5, 6)]
    assert {k for k in h if k[0] == 7} == {(7, "http://d/1"), (7, "http://d/3")}
    # doc 2 matches both OR groups of query 4: "red" counts in each group
    assert h[(4, "http://d/2")] > h[(1, "http://d/2")]


def test_bm25_value(spark):
    h = _hits(spark, [(1, 0, "title", "green")])
    n, df, tf, length, avg = 3, 1, 1, 2, 5 / 3
    idf = math.log(n / (df + 1)) + 1
    expect = 1.5 * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / avg))
    assert abs(h[(1, "http://d/2")] - round(expect, 6)) < 1e-6


def test_both_is_pagerank_plus_bm25(spark):
    ranks = spark.createDataFrame([("http://d/1", 1e-4), ("http://d/2", 2e-4), ("http://d/3", 3e-4)],
                                  "url string, pr double")
    q = [(1, 0, "title", "red blue"), (2, 0, "title", "red")]
    b = _hits(spark, q, "bm25")
    p = _hits(spark, q, "pagerank", ranks)
    both = _hits(spark, q, "both", ranks)
    assert b.keys() == p.keys() == both.keys()
    for k in both:
        assert abs(both[k] - (b[k] + p[k])) < 2e-6
    # PageRank is added once per matching term: query 1 has two terms
    assert abs(p[(1, "http://d/1")] - 2 * 100000 * 1e-4) < 1e-6


def test_unknown_mode_rejected(spark):
    import pytest
    with pytest.raises(ValueError):
        SE.score(spark.createDataFrame([], "query_id long, url string, n_terms long, bm25_sum double"),
                 mode="tfidf")


def _ranked(spark, rows):
    return spark.createDataFrame(rows, "query_id long, url string, rank int")


def test_merges(spark):
    a = _ranked(spark, [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 1), (2, "b", 2)])
    b = _ranked(spark, [(1, "c", 1), (1, "d", 2), (1, "a", 3), (2, "x", 1)])
    up = {(r.query_id, r.rank): (r.url, r.exact) for r in SE.upgrade(a, b).collect()}
    assert [up[(1, i)][0] for i in (1, 2, 3)] == ["a", "c", "b"]       # overlap first, A order
    assert [up[(2, i)][0] for i in (1, 2)] == ["a", "b"]                # disjoint: unchanged
    ue = {(r.query_id, r.rank): r.url for r in SE.upgrade_and_extend(a, b).collect()}
    assert [ue[(1, i)] for i in (1, 2, 3, 4)] == ["a", "c", "b", "d"]
    assert [ue[(2, i)] for i in (1, 2, 3)] == ["a", "b", "x"]
    empty = _ranked(spark, [])
    assert sorted(tuple(r) for r in SE.upgrade_and_extend(a, empty).collect()) == \
        sorted(tuple(r) for r in a.collect())
    assert sorted(tuple(r) for r in SE.upgrade_and_extend(empty, b).collect()) == \
        sorted(tuple(r) for r in b.collect())
    # upgrade is a permutation of A
    assert sorted(r.url for r in SE.upgrade(a, b).where("query_id = 1").collect()) == ["a", "b", "c"]


def test_paging(spark):
    ranked = _ranked(spark, [(q, f"u{i}", i) for q, n in ((1, 1), (2, 10), (3, 11)) for i in range(1, n + 1)])
    req = spark.createDataFrame([(0, -1), (1, 0), (2, 1), (2, 2), (3, 2), (3, 99), (3, 1)],
                                "query_id long, page int")
    got = SE.page_slice(ranked, req).collect()
    by = {}
    for r in got:
        by.setdefault((r.query_id, r.page_no, r.total), []).append(r.rank)
    assert by[(0, 1, 0)] == [None]                       # no hits: one empty page
    assert sorted(by[(1, 1, 1)]) == [1]
    assert sorted(by[(2, 1, 10)]) == sorted(list(range(1, 11)) * 2)   # page 2 → clamped to 1
    assert sorted(by[(3, 2, 11)]) == [11, 11]            # page 2 and 99 → last page
    assert sorted(by[(3, 1, 11)]) == list(range(1, 11))
    pages = SE.with_pages(ranked).where("query_id = 3").collect()
    assert sorted(r.page_no for r in pages) == [1] * 10 + [2]


def test_equal_queries_are_searched_once(spark, monkeypatch):
    """Queries of the same terms are one class, matched and ranked once; every
    query gets the rows, also one without an id and those of a large class."""
    monkeypatch.setattr(SE, "MEMBER_ROWS", 8)
    ix, seen, match = _index(spark), [], SE.match_groups

    def counted(qterms, index):
        seen.append(qterms.select("query_id").distinct().count())
        return match(qterms, index)

    monkeypatch.setattr(SE, "match_groups", counted)
    texts = [(i, "red") for i in range(40)] + [(None, "red"), (50, "Red, red!"), (51, "blue red"), (52, "blue"),
                                               (53, "purple"), (54, ""), (55, None)]
    queries = spark.createDataFrame(texts, "query_id long, query string")
    got = sorted((str(r.query_id), r.url, r.rank) for r in SE.search(queries, ix, "bm25").collect())
    red = [("http://d/1", 1), ("http://d/2", 2)]
    want = [(str(i), *hit) for i in [*range(40), None, 50] for hit in red]
    want += [("51", "http://d/1", 1), ("52", "http://d/3", 1), ("52", "http://d/1", 2)]
    assert got == sorted(want)
    terms = SE.analyze_groups(SE.title_queries(queries), stem=False, dedup_groups=False)
    first = sorted((str(r.query_id), r.url, r.rank) for r in SE.first_hits(terms, ix, 1).collect())
    assert first == sorted(w for w in want if w[2] == 1)
    top = SE.submit(queries, ix, mode="bm25").where("query_id < 40")
    assert sorted((r.url, r.rank) for r in top.collect()) == sorted(red * 40)
    assert seen == [4] * 3  # red, blue red, blue, purple


def test_groups_are_analyzed_once(spark):
    g = spark.createDataFrame([(1, 0, "title", "a b"), (1, 1, "title", "b a"), (1, 2, "content", "tokens")],
                              "query_id long, group_id int, field string, text string")
    rows = SE.analyze_groups(g, stem=False)
    assert "Generate" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in rows.collect()) == [
        (1, 0, "title", "a"), (1, 0, "title", "b"), (1, 2, "content", "tokens")]


def test_pages_stay_where_they_are(spark):
    from tests.conftest import SF001
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    again = pages.where("page_id < 3").withColumn("page_id", F.lit(None).cast("long"))
    twice = pages.where("page_id = 5")
    rows = pages.unionByName(again).unionByName(twice)
    rows = rows.unionByName(again.limit(1).withColumn("url", F.lit(None).cast("string")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # less than the pages
    try:
        kept = IX.one_per_url(rows)
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.page_id, r._copies) for r in kept.collect())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many such URLs
        assert sorted((r.page_id, r._copies) for r in IX.one_per_url(rows).collect()) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    n = pages.count()
    assert got == sorted([(i, 2 if i == 5 else 1) for i in range(n)] + [(5, 2)])


def test_title_searches_index_titles_only(spark, monkeypatch):
    from quarry.plans import searching as PS
    from tests.conftest import SF001
    made = []
    monkeypatch.setattr(PS, "_OPEN", {})
    monkeypatch.setattr(PS, "path_exists", lambda *a: True)
    monkeypatch.setattr(PS.SI, "open_index", lambda spark, path: made.append(path))
    PS.title_index(spark, SF001)
    PS.both_fields_index(spark, SF001)
    assert "content" not in made[0] and "content" in made[1]


def test_results_of_a_class_are_dealt_in_cells(spark, monkeypatch):
    """A class of many queries and many results is cut both ways; every query
    gets every result once."""
    monkeypatch.setattr(SE, "MEMBER_ROWS", 3)
    monkeypatch.setattr(SE, "RESULT_ROWS", 2)
    members = spark.createDataFrame([(i, i // 10) for i in range(12)] + [(None, 0), (99, 7)],
                                    "query_id long, qclass long")
    results = spark.createDataFrame([(c, f"u{r}", r) for c, n in ((0, 5), (1, 1)) for r in range(1, n + 1)],
                                    "query_id long, url string, rank int")
    got = sorted((-1 if r.query_id is None else r.query_id, r.url, r["rank"])
                 for r in SE.for_members(results, members).collect())
    assert got == sorted([(q, f"u{r}", r) for q in [*range(10), -1] for r in range(1, 6)]
                         + [(q, "u1", 1) for q in (10, 11)])
