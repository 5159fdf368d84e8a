"""Crawl-planning queries: S3, S10, F3-F6, R6, R7, A17."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import urls as U
from quarry.operators import frontier as FR
from quarry.operators import links as L
from quarry.plans import sqlfrag as Q
from quarry.plans.corpus import RESOLVED_SQL
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import files as FS
from quarry.sources import tables as S

# Robots rules and delays are inputs (fetching robots files is outside the
# engine). The queries below use this small rule table for every host
# (domain '*'): an allow listed before a broader disallow, to exercise the
# first-match rule.
DEFAULT_RULES = [("*", 1, True, "/fr/8"), ("*", 2, False, "/fr/"), ("*", 3, False, "/es/")]
# One request per 5 s and no crawl delay: delay = max(3 s default, 5 s).
DEFAULT_DELAYS = [("*", 0.0, 5.0, 1)]


def rules_df(spark: SparkSession) -> DataFrame:
    return S.literal_table(spark, DEFAULT_RULES, FR.ROBOTS_SCHEMA)


def delays_df(spark: SparkSession) -> DataFrame:
    return S.literal_table(spark, DEFAULT_DELAYS, FR.DELAY_SCHEMA)


def _rules_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT {Q.lit(d)} AS domain, {s} AS seq, {str(a).upper()} AS allow, {Q.lit(p)} AS prefix"
        for d, s, a, p in DEFAULT_RULES)


# Rules of hosts of their own, derived from the pages: a host's file allows the
# beginning of its first path and then forbids a shorter beginning of its last.
HOST_RULES_SQL = f"""
SELECT domain, seq, allow, prefix FROM (
  SELECT {Q.host('url')} AS domain, min(regexp_extract(url, '^[a-z]+://[^/]*(.*)', 1)) AS a,
         max(regexp_extract(url, '^[a-z]+://[^/]*(.*)', 1)) AS z FROM pages WHERE page_id % 2 = 0 GROUP BY 1),
  LATERAL (VALUES (1, TRUE, left(a, 6)), (2, FALSE, left(z, 4)), (3, FALSE, left(z, 5))) AS r(seq, allow, prefix)"""


def host_rules(spark: SparkSession, sf: str) -> DataFrame:
    path = F.regexp_extract("url", "^[a-z]+://[^/]*(.*)", 1)
    own = (S.pages(spark, sf).where("page_id % 2 = 0").groupBy(U.host(F.col("url")).alias("domain"))
           .agg(F.min(path).alias("a"), F.max(path).alias("z")))
    return own.select("domain", F.inline(F.expr(
        "array(struct(1, true, left(a, 6)), struct(2, false, left(z, 4)), struct(3, false, left(z, 5)))"))
        .alias("seq", "allow", "prefix"))


def robots_sql(urls_sql: str, more_rules: str = "") -> str:
    path = ("CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^#]*)', 1) = '' "
            "THEN '/' ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^#]*)', 1) END")
    return f"""
WITH u AS (SELECT DISTINCT url FROM ({urls_sql})),
r AS ({_rules_sql()}{more_rules}),
uh AS (SELECT url, {Q.host('url')} AS host FROM u),
ud AS (SELECT uh.url, CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.domain = uh.host)
                           THEN uh.host ELSE '*' END AS rd FROM uh),
m AS (SELECT ud.url, arg_min(CASE WHEN r.prefix = '' THEN TRUE ELSE r.allow END, r.seq) AS decided
      FROM ud JOIN r ON r.domain = ud.rd
      WHERE r.prefix IN ('', '*') OR starts_with({path.replace('url', 'ud.url')}, r.prefix)
      GROUP BY ud.url)
SELECT u.url, coalesce(m.decided, TRUE) AS allowed FROM u LEFT JOIN m ON m.url = u.url"""


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return L.resolved_links(S.pages(spark, sf))


def frontier_df(spark: SparkSession, sf: str) -> DataFrame:
    pages = S.pages(spark, sf)
    return FR.frontier(L.resolved_links(pages), pages.select("url"), rules_df(spark))


def frontier_sql() -> str:
    links = f"""
SELECT page_id, url, pos - 1 AS pos, href FROM (
  SELECT page_id, url, unnest({Q.anchor_hrefs('html')}) AS href,
         generate_subscripts({Q.anchor_hrefs('html')}, 1) AS pos FROM pages)
WHERE href <> ''"""
    resolved = f"SELECT page_id, url, pos, {Q.resolve('url', 'href')} AS dst FROM ({links})"
    return f"""
WITH l AS ({resolved}),
first AS (SELECT dst AS url, arg_min(page_id, (page_id, pos)) AS page_id,
                 arg_min(pos, (page_id, pos)) AS pos, arg_min(url, (page_id, pos)) AS src
          FROM l GROUP BY dst),
cand AS (SELECT * FROM first WHERE url NOT IN (SELECT url FROM pages) AND {Q.port_ok('url')}),
ok AS (SELECT url FROM ({robots_sql('SELECT url FROM cand')}) WHERE allowed),
c2 AS (SELECT c.*, {Q.host('c.url')} AS host, {Q.host('c.url')} = {Q.host('c.src')} AS preferred
       FROM cand c WHERE c.url IN (SELECT url FROM ok))
SELECT url, host, preferred,
       row_number() OVER (ORDER BY preferred DESC,
                          CASE WHEN preferred THEN -page_id ELSE page_id END,
                          CASE WHEN preferred THEN -pos ELSE pos END, url) AS position
FROM c2"""


@register("new_pages", sql=f"""
SELECT DISTINCT dst AS url FROM ({RESOLVED_SQL}) WHERE dst NOT IN (SELECT url FROM pages)""")
def new_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = S.pages(spark, sf)
    incoming = L.resolved_links(pages).select(F.col("dst").alias("url"))
    return FR.new_pages(incoming, pages)


@register("seed_order", sql=f"""
SELECT {Q.host('url')} AS domain, url,
       row_number() OVER (PARTITION BY {Q.host('url')} ORDER BY page_id DESC, url) AS position
FROM pages""")
def seed_order(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as sitemap entries: domain = host, sitemap order = page_id."""
    seeds = S.pages(spark, sf).select(U.host(F.col("url")).alias("domain"),
                                      F.col("page_id").alias("seq"), "url")
    return FR.seed_order(seeds)


@register("seed_lists", sql=f"""
WITH p AS (SELECT {Q.host('url')} AS domain, page_id, url FROM pages),
c AS (SELECT domain FROM p GROUP BY domain HAVING min(page_id) % 2 = 0),
s AS (SELECT domain, url, -page_id AS seq FROM p WHERE domain IN (SELECT domain FROM c)
      UNION ALL SELECT domain, url, page_id FROM p WHERE domain NOT IN (SELECT domain FROM c))
SELECT domain, url, row_number() OVER (PARTITION BY domain ORDER BY seq DESC, url) AS position FROM s""")
def seed_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Sitemaps of all hosts written and read as XML; the hosts whose
    first page has an even id have a cached list, in the reverse order."""
    seeds = S.pages(spark, sf).select(U.host(F.col("url")).alias("domain"),
                                      F.col("page_id").alias("seq"), "url")
    path = scratch_path(spark, f"sitemaps-{uuid.uuid4().hex}")
    FS.write_sitemaps(seeds, path)
    have = seeds.groupBy("domain").agg(F.min("seq").alias("m")).where("m % 2 = 0").select("domain")
    cached = seeds.join(have, "domain", "left_semi").withColumn("seq", -F.col("seq"))
    return FR.seed_order(FR.seed_lists(cached, FS.read_sitemaps(spark, path)))


@register("robots_filter", sql=robots_sql(f"SELECT url FROM pages UNION SELECT dst FROM ({RESOLVED_SQL})"))
def robots_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = S.pages(spark, sf)
    urls = pages.select("url").unionByName(
        L.resolved_links(pages).select(F.col("dst").alias("url")))
    return FR.robots_allowed(urls, rules_df(spark))


@register("robots_by_host", sql=robots_sql(
    f"SELECT url FROM pages UNION SELECT dst FROM ({RESOLVED_SQL})", f" UNION ALL {HOST_RULES_SQL}"))
def robots_by_host(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts with rules of their own beside the shared ones."""
    pages = S.pages(spark, sf)
    urls = pages.select("url").unionByName(
        L.resolved_links(pages).select(F.col("dst").alias("url")))
    return FR.robots_allowed(urls, rules_df(spark).unionByName(host_rules(spark, sf)))


@register("frontier", sql=frontier_sql())
def frontier(spark: SparkSession, sf: str) -> DataFrame:
    return frontier_df(spark, sf)


@register("fetch_schedule", sql=f"""
WITH f AS ({frontier_sql()})
SELECT url, host,
       CAST(row_number() OVER (PARTITION BY host ORDER BY position) - 1 AS DOUBLE)
       * greatest(coalesce(nullif({DEFAULT_DELAYS[0][1]}, 0.0), 3.0),
                  {DEFAULT_DELAYS[0][2]} / {DEFAULT_DELAYS[0][3]}) AS offset_seconds
FROM f""")
def fetch_schedule(spark: SparkSession, sf: str) -> DataFrame:
    return FR.fetch_schedule(frontier_df(spark, sf), delays_df(spark))


@register("host_counts", sql=f"""
SELECT {Q.host('url')} AS host, count(*) AS n_pages FROM pages GROUP BY 1""")
def host_counts(spark: SparkSession, sf: str) -> DataFrame:
    return FR.host_counts(S.pages(spark, sf))
