"""Physical-plan checks: pruning reaches the parquet scan; top-k is partial."""
from conftest import SF001

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_url_only_query_does_not_read_html(spark):
    plan = _plan(E.queries()["host_counts"](spark, SF001))
    assert "ReadSchema: struct<url:string>" in plan


def test_filter_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    from quarry.sources import tables as S
    df = S.table(spark, SF001, "part").where(F.col("p_size") <= 25).select("p_partkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(p_size), LessThanOrEqual(p_size,25)]" in plan


def test_top_hits_is_partial_before_shuffle(spark):
    from quarry.operators import search as SE
    hits = spark.range(1000).selectExpr("id % 3 as query_id", "cast(id as string) as url",
                                        "cast(id as double) as score")
    plan = _plan(SE.top_hits(hits, 10))
    assert "WindowGroupLimit" in plan
