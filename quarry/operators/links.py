"""Link extraction and the link graph.

Links come from one generator (``posexplode`` of the anchor array) per page,
so extraction is a narrow map over the page scan. Every grouping below is a
hash aggregate with a map-side partial step, so a page or target holding a
large share of all links is pre-combined inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import urls as U
from quarry.functions.constants import STRICT_LINK_PATTERNS


def strict_ok(href):
    """reject hrefs that contain any strict pattern (and empty ones)."""
    cond = href != ""
    for p in STRICT_LINK_PATTERNS:
        cond = cond & ~href.contains(p)
    return cond


def page_links(pages: DataFrame, strict: bool = False) -> DataFrame:
    """T1 + F2 (or F1 when ``strict``): ``(page_id, url, pos, href)``."""
    df = pages.select("page_id", "url",
                      F.posexplode(H.anchor_hrefs(F.col("html"))).alias("pos", "href"))
    cond = strict_ok(F.col("href")) if strict else (F.col("href") != "")
    return df.where(cond)


def resolved_links(pages: DataFrame, strict: bool = False) -> DataFrame:
    """``(page_id, url, pos, dst)`` — each link resolved against its page."""
    return (page_links(pages, strict)
            .select("page_id", "url", "pos",
                    U.resolve(F.col("url"), F.col("href")).alias("dst")))


def doc_ids(pages: DataFrame, digest=None) -> DataFrame:
    """File name per stored URL — SHA-256 + ``.html``; the second URL
    with the same digest gets ``_0``, the third ``_1`` …; a URL seen again is
    not stored again (the first arrival, lowest page_id, keeps it).
    ``digest`` replaces SHA-256 (tests force collisions with it)."""
    firsts = pages.groupBy("url").agg(F.min("page_id").alias("first_id"))
    h = firsts.withColumn("hash", digest(F.col("url")) if digest else U.doc_hash(F.col("url")))
    # digest groups hold one URL unless SHA-256 collides: the window is tiny
    w = Window.partitionBy("hash").orderBy("first_id")
    rn = F.row_number().over(w)
    suffix = F.when(rn == 1, F.lit("")).otherwise(F.concat(F.lit("_"), (rn - 2).cast("string")))
    return h.select("url", F.concat(F.col("hash"), suffix, F.lit(".html")).alias("doc_id"))


# ------------------------------------------------------------ graph ---------

def link_counts(pages: DataFrame, strict: bool = True) -> DataFrame:
    """A1: multiplicity of each (page, target) link: ``(src, dst, n)``."""
    return (resolved_links(pages, strict)
            .groupBy(F.col("url").alias("src"), "dst")
            .agg(F.count(F.lit(1)).alias("n")))


def distinct_links(pages: DataFrame) -> DataFrame:
    """A3: the crawler's out-link sets (loose filter): ``(src, dst)``."""
    return (resolved_links(pages, strict=False)
            .select(F.col("url").alias("src"), "dst").distinct())


def adjacency_map(counts: DataFrame) -> DataFrame:
    """A2: ``(src, targets MAP<dst, n>)`` — the nested form of the counts.
    Each map holds one page's out-links, i.e. is bounded by that page's html."""
    return (counts.groupBy("src")
            .agg(F.map_from_entries(F.collect_list(F.struct("dst", "n"))).alias("targets")))


def corpus_edges(counts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Keep counts whose target is itself in the corpus, no self edge.

    ``nodes(node)`` is semi-joined (never densified to an n×n matrix)."""
    return (counts.where(F.col("src") != F.col("dst"))
            .join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi")
            .select("src", "dst", "n"))


def binary_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """0/1 adjacency with a forced self edge on every node, restricted
    to targets in the node set: ``(src, dst)``."""
    e = (edges.select("src", "dst")
         .join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi"))
    selfs = nodes.select(F.col("node").alias("src"), F.col("node").alias("dst"))
    return e.unionByName(selfs).distinct()


def url_graph(pages: DataFrame, symmetric: bool = False):
    """URL graph of the corpus: edges page → resolved target (weighted by
    link count, strict filter), nodes = pages ∪ targets.

    ``symmetric`` adds every edge reversed (target → page, same weight):
    rank then flows page → target → page, so pages are ranked by the
    targets they share without ever pairing pages (no co-link self-join).
    Returns ``(edges(src, dst, n), pages(node))``; the node set is the pages
    plus every edge end.
    """
    counts = link_counts(pages, strict=True).where(F.col("src") != F.col("dst"))
    if symmetric:
        # both directions from one pass over the counts (a generator, not a
        # union of two scans)
        both = F.explode(F.array(
            F.struct(F.col("src").alias("a"), F.col("dst").alias("b"), "n"),
            F.struct(F.col("dst").alias("a"), F.col("src").alias("b"), "n")))
        counts = (counts.select(both.alias("e"))
                  .groupBy(F.col("e.a").alias("src"), F.col("e.b").alias("dst"))
                  .agg(F.sum("e.n").alias("n")))
    nodes = pages.select(F.col("url").alias("node"))
    return counts, nodes


def part_graph(lineitem: DataFrame) -> DataFrame:
    """Weighted part graph: within each order, each line's part links to the
    next line's part (order by line number, then part key); self edges
    dropped. ``(src, dst, n)`` as BIGINT node ids.

    The next line comes from a global sort and an equi-join on position
    (``sequence.next_in_group``), not a window per order, so an order with a
    huge number of lines is still cut over many tasks."""
    from quarry.operators.sequence import next_in_group
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    steps = (next_in_group(li, ["l_orderkey"], ["l_linenumber", "l_partkey"], "l_partkey", "nxt")
             .where(F.col("nxt").isNotNull() & (F.col("nxt") != F.col("l_partkey"))))
    return (steps.groupBy(F.col("l_partkey").alias("src"), F.col("nxt").alias("dst"))
            .agg(F.count(F.lit(1)).alias("n")))


def part_nodes(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_partkey").alias("node")).distinct()
