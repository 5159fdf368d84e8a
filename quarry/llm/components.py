"""Connected components of a link table by alternating star contractions.

Large star: every node links its larger neighbours to the smallest node next
to it; small star: every node links itself and its smaller neighbours to the
smallest of them. Both keep the components; repeated, every component becomes
a star around its smallest node after a number of rounds that grows with the
logarithm of its size. Each round is one aggregation and one join; its edges
are written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import discard, stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of links (a, b); a hot node's rows are summed before
    the shuffle and its join is left to skew handling."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where(F.col("a") > F.col("b"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    moved = both.join(least, "a")
    if large:
        return moved.where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    return (moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node that
    occurs in ``links`` (two columns ``a`` and ``b`` of one ordered type)."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "links")
    size = None
    while True:
        done = stored(_star(_star(edges, True), False), "links")
        discard(edges)
        edges = done
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == size:  # the same edges twice: every component is a star
            break
        size = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
