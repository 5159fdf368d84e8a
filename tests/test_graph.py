"""Link graph and PageRank (S4, A1-A8, J1, J2; README's three-URL case)."""
import os

from pyspark.sql import functions as F

from quarry.operators import links as L
from quarry.operators import pagerank as PR
from quarry.sources import files as FS

THREE = ",\turl1,\turl2,\turl3\nurl1,\t1,\t0,\t1\nurl2,\t0,\t1,\t1\nurl3,\t0,\t0,\t1\n"


def _three_url(spark, tmp_dir):
    path = os.path.join(tmp_dir, "adj.csv")
    with open(path, "w") as f:
        f.write(THREE)
    e = FS.read_adjacency_csv(spark, path)
    return e.select("src", "dst", F.col("w").alias("n"))


def test_matrix_to_edges(spark, tmp_dir):
    e = _three_url(spark, tmp_dir)
    assert sorted((r.src, r.dst, r.n) for r in e.collect()) == [
        ("url1", "url1", 1.0), ("url1", "url3", 1.0), ("url2", "url2", 1.0),
        ("url2", "url3", 1.0), ("url3", "url3", 1.0)]


def test_pagerank_three_url_closed_form(spark, tmp_dir):
    e = _three_url(spark, tmp_dir)
    r = {x.node: x.pr for x in PR.pagerank(e, epsilon=1e-9, max_iter=500).collect()}
    assert abs(r["url1"] - 0.086957) < 1e-6 and abs(r["url2"] - 0.086957) < 1e-6
    assert abs(r["url3"] - 0.826087) < 1e-6
    d = {x.node: round(x.pr, 6) for x in PR.pagerank(e).collect()}   # default epsilon 1e-4
    assert d == {"url1": 0.086977, "url2": 0.086977, "url3": 0.826047}


def test_transitions_sum_to_one(spark):
    e = spark.createDataFrame([("a", "b", 2), ("a", "c", 1), ("b", "c", 5)], "src string, dst string, n long")
    sums = PR.transitions(e).groupBy("src").agg(F.sum("p").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in sums)


def test_pagerank_properties(spark):
    # no dangling node: ranks sum to 1; a dangling node loses mass (no redistribution)
    cyc = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("a", "c", 1)],
                                "src string, dst string, n long")
    r = PR.pagerank(cyc, rounds=30).agg(F.sum("pr")).first()[0]
    assert abs(r - 1) < 1e-9
    dang = spark.createDataFrame([("a", "b", 1)], "src string, dst string, n long")
    r2 = {x.node: x.pr for x in PR.pagerank(dang, rounds=1).collect()}
    assert abs(r2["a"] - 0.075) < 1e-12 and abs(r2["b"] - (0.075 + 0.85 * 0.5)) < 1e-12


def test_pagerank_partition_independent(spark):
    e = spark.createDataFrame([(f"n{i}", f"n{(i * 7 + 3) % 40}", 1 + i % 3) for i in range(120)],
                              "src string, dst string, n long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        a = {x.node: round(x.pr, 12) for x in PR.pagerank(e, rounds=7).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = {x.node: round(x.pr, 12) for x in PR.pagerank(e, rounds=7).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_corpus_and_binary_edges(spark):
    counts = spark.createDataFrame([("a", "b", 2), ("a", "x", 1), ("b", "b", 4), ("b", "a", 1)],
                                   "src string, dst string, n long")
    nodes = spark.createDataFrame([("a",), ("b",)], "node string")
    ce = sorted(tuple(r) for r in L.corpus_edges(counts, nodes).collect())
    assert ce == [("a", "b", 2), ("b", "a", 1)]
    be = sorted(tuple(r) for r in L.binary_edges(counts, nodes).select("src", "dst").collect())
    assert be == [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")]


def test_link_counts_and_map(spark):
    html = '<a href="/x">1</a><a href="/x">2</a><a href="http://o/y">3</a><a href="#t">4</a>'
    pages = spark.createDataFrame([(1, "http://h/p", html)], "page_id long, url string, html string")
    c = {(r.dst): r.n for r in L.link_counts(pages).collect()}
    assert c == {"http://h/x": 2, "http://o/y": 1}
    m = L.adjacency_map(L.link_counts(pages)).first()
    assert dict(m.targets) == c


def _plain_rounds(edges, nodes, rounds, d=0.85):
    out = {}
    for s, _, n in edges:
        out[s] = out.get(s, 0) + n
    pr = {v: 1 / len(nodes) for v in nodes}
    for _ in range(rounds):
        new = {v: (1 - d) / len(nodes) for v in nodes}
        for s, t, n in edges:
            new[t] += d * pr[s] * n / out[s]
        pr = new
    return pr


def test_hot_source_is_dealt_over_tasks(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(PR, "HOT_EDGES", 100)
    rows = [("hub", f"n{i}", 1 + i % 2) for i in range(800)] + [(f"n{i}", f"n{(i * 7) % 800}", 1) for i in range(800)]
    e = spark.createDataFrame(rows, "src string, dst string, n long")
    names = {x for r in rows for x in r[:2]}
    got = {r.node: r.pr for r in PR.pagerank(e, rounds=4).collect()}
    want = _plain_rounds(rows, names, 4)
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-12 for v in want)
    nodes = spark.createDataFrame([(v,) for v in names], "node string")
    t = PR.split_transitions(e, nodes, 4, tmp_dir, "test")
    spark.sql("DROP TABLE quarry_pr_test_trans")
    assert [r.node for r in t.sources.collect()] == ["hub"]
    sizes = [r["count"] for r in t.hot.groupBy(F.spark_partition_id()).count().collect()]
    files = [r["count"] for r in t.hot.groupBy("_metadata.file_name").count().collect()]
    assert sum(sizes) == 800 and len(files) == 4 and max(files) < 300


def test_changes_reach_the_same_fixed_point(spark):
    rows = [(f"n{i}", f"n{(i * 7 + k * k) % 60}", 1) for i in range(60) for k in range(4)] + [("x", "n1", 2)]
    e = spark.createDataFrame(rows, "src string, dst string, n long")
    got = {r.node: r.pr for r in PR.pagerank(e, epsilon=1e-12, max_iter=300).collect()}
    want = _plain_rounds(rows, {v for r in rows for v in r[:2]}, 250)
    assert all(abs(got[v] - want[v]) < 1e-11 for v in want)
    # a node that nobody links to stops sending after the first round
    nodes = spark.createDataFrame([(v,) for v in want], "node string")
    state = nodes.selectExpr("node", "0.5D AS pr", "CASE WHEN node = 'x' THEN 0.0D ELSE 0.1D END AS change")
    t = PR.Transitions(PR.transitions(e), None, None)
    after = {r.node: r for r in PR.change_step(t, state).collect()}
    assert after["x"].change == 0 and len(after) == len(want)


def test_no_rounds_and_no_nodes(spark):
    e = spark.createDataFrame([("a", "b", 1)], "src string, dst string, n long")
    assert {r.node: r.pr for r in PR.pagerank(e, rounds=0).collect()} == {"a": 0.5, "b": 0.5}
    assert PR.pagerank(e.limit(0), rounds=3).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("quarry_pr")]
