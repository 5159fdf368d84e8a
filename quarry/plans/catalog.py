"""The query catalogue: importing the plan modules fills the registry."""

from __future__ import annotations

from quarry.plans import corpus, crawl, dictionary, graph, logs, related_q, searching  # noqa: F401  (registration)
from quarry.plans.registry import ORACLES, QUERIES


def _shipped(fn):
    """Wrap a query so the package reaches the executors before it runs."""
    import functools

    from quarry.session import ship_package

    @functools.wraps(fn)
    def run(spark, sf_dir):
        ship_package(spark)
        return fn(spark, sf_dir)
    return run


def queries():
    return {name: _shipped(fn) for name, fn in QUERIES.items()}


def oracle_sql():
    return {k: v.strip() for k, v in ORACLES.items() if k in QUERIES}


def flagship(spark, sf_dir):
    """Combined BM25 + PageRank search of every page title; the first page of
    results of each query with title and URL, on the stored index."""
    from quarry.functions.constants import PAGE_LEN
    from quarry.operators import search as SE
    from quarry.plans.graph import page_ranks
    from quarry.plans.searching import title_index, title_query_table

    ix = title_index(spark, sf_dir)
    qterms = SE.analyze_groups(SE.title_queries(title_query_table(spark, sf_dir)),
                               stem=False, dedup_groups=False)
    scored = SE.score(SE.match_groups(qterms, ix), "both", page_ranks(spark, sf_dir))
    return (SE.top_hits(scored, PAGE_LEN).join(ix.docs.select("url", "title"), "url", "left")
            .select("query_id", "rank", "title", "url", "score"))
