"""Driver contract: entry(), queries(), oracle_sql(); oracle agreement."""
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, digest  # noqa: E402

FAST = ["page_scan", "page_links", "resolved_links", "doc_ids", "page_text", "clean_titles",
        "tokens", "title_postings", "content_postings", "field_stats", "search_bm25",
        "link_counts", "transitions", "pagerank", "suggest", "frontier", "mode_replay",
        "debounced_events", "most_similar", "search_expanded"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["query_id", "rank", "title", "url", "score"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the library's own queries; opN_ and pipeline come with quarry.llm
    assert len([n for n in q if not n.startswith("op") and n != "pipeline"]) >= 55


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]
