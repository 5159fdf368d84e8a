"""Randomised properties: URL resolution and sequencing helpers."""
from urllib.parse import urljoin

from hypothesis import Phase, given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import urls as U
from quarry.operators import sequence as SQ

seg = st.sampled_from(["a", "b", ".", "..", "", "c.d", "x y"])
path = st.lists(seg, min_size=0, max_size=5).map("/".join)
href = st.tuples(st.sampled_from(["", "/", "?q=1", "#f"]), path,
                 st.sampled_from(["", "?z", "#t", "?z#t"])).map(
    lambda t: (t[0] + t[1] + t[2]) if t[0] in ("", "/") else (t[0] + t[2]))
base = st.tuples(st.sampled_from(["http://h", "https://h:8080"]), path,
                 st.sampled_from(["", "?x", "#y", "?x#y"])).map(
    lambda t: t[0] + "/" + t[1] + t[2])


@settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.tuples(base, href), min_size=20, max_size=40))
def test_resolve_random(spark, pairs):
    df = spark.createDataFrame(pairs, "b string, h string")
    got = df.select("b", "h", U.resolve(F.col("b"), F.col("h")).alias("r")).collect()
    assert [(r.b, r.h, r.r) for r in got if r.r != urljoin(r.b, r.h)] == []


@settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20),
                          st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                min_size=1, max_size=80),
       st.integers(1, 9))
def test_group_rank_and_fill_forward_random(spark, rows, block):
    data = [(i, g, t, v) for i, (g, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g long, t long, v string")
    w = Window.partitionBy("g").orderBy("t", "id")
    exp = {r.id: (r.r, r.f) for r in df.select(
        "id", F.row_number().over(w).alias("r"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("f")).collect()}
    gr = {r.id: r.rank for r in SQ.group_rank(df, ["g"], ["t", "id"]).collect()}
    ff = {r.id: r.f for r in SQ.fill_forward(df, ["g"], ["t", "id"], "v", "f", block).collect()}
    assert all(gr[i] == exp[i][0] and ff[i] == exp[i][1] for i in exp)


def test_group_rank_over_partitions_of_one_group(spark):
    """Groups that span many partitions, many groups in one, struct keys, nulls."""
    rows = [((0, "hot"), i) for i in range(500)] + [((i % 40, None if i % 3 else "x"), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g struct<a:int,b:string>, v long").repartition(7)
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = {(tuple(r.g), r.v): (r.rank, r["_gpos"]) for r in SQ.group_rank(df, ["g"], [F.desc("v")]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    places = {}
    for g, v in sorted(rows, key=lambda r: (r[0][0], r[0][1] or "", -r[1])):
        places.setdefault(g, []).append(v)
        assert got[g, v][0] == len(places[g])
    assert sorted(p for _, p in got.values()) == list(range(1, len(rows) + 1))
    empty = SQ.group_rank(df.limit(0), ["g"], ["v"])
    assert empty.count() == 0 and "rank" in empty.columns


def test_ranking_moves_the_rows_once(spark):
    from tests.test_stored_index import plan_of
    df = spark.createDataFrame([(i % 3, i) for i in range(50)], "g int, v int")
    sent = []
    keep = type(df).checkpoint
    type(df).checkpoint = lambda self, **k: (sent.append(plan_of(self)), keep(self, **k))[1]
    try:
        ranked = SQ.group_rank(df, ["g"], ["v"])
    finally:
        type(df).checkpoint = keep
    assert len(sent) == 1 and sent[0].split("(1) ")[0].count("Exchange") == 1
    # after the checkpoint only tables of one row per partition are exchanged
    assert "SortMergeJoin" not in plan_of(ranked) and "BroadcastHashJoin" in plan_of(ranked)
