"""Scans and per-page functions: S1, S2, T1-T14, F1, F2 (and their oracles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import text as TX
from quarry.functions import urls as U
from quarry.functions.constants import STRICT_LINK_PATTERNS
from quarry.operators import links as L
from quarry.plans import sqlfrag as Q
from quarry.plans.registry import register
from quarry.sources import tables as S


# ---------------------------------------------------------------- scans ----

@register("page_scan", sql="""
SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages""")
def page_scan(spark: SparkSession, sf: str) -> DataFrame:
    return S.pages(spark, sf).select("page_id", "url",
                                     F.length("html").cast("long").alias("n_chars"))


@register("clean_text_scan", sql="""
SELECT doc_id, lang, sha256(text) AS text_hash FROM documents""")
def clean_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    return S.documents(spark, sf).select("doc_id", "lang",
                                         F.sha2("text", 256).alias("text_hash"))


# ---------------------------------------------------------------- links ----

_LINKS_SQL = f"""
SELECT page_id, url, href FROM (
  SELECT page_id, url, unnest({Q.anchor_hrefs('html')}) AS href FROM pages)
WHERE href <> ''"""


@register("page_links", sql=f"SELECT page_id, href FROM ({_LINKS_SQL})")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_links(S.pages(spark, sf)).select("page_id", "href")


_STRICT_SQL = " AND ".join(f"NOT contains(href, {Q.lit(p)})" for p in STRICT_LINK_PATTERNS)


@register("filtered_links", sql=f"""
SELECT page_id, href FROM ({_LINKS_SQL}) WHERE {_STRICT_SQL}""")
def filtered_links(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_links(S.pages(spark, sf), strict=True).select("page_id", "href")


RESOLVED_SQL = f"""
SELECT page_id, url, {Q.resolve('url', 'href')} AS dst FROM ({_LINKS_SQL})"""
STRICT_RESOLVED_SQL = f"""
SELECT page_id, url, {Q.resolve('url', 'href')} AS dst FROM ({_LINKS_SQL})
WHERE {_STRICT_SQL}"""


@register("resolved_links", sql=f"SELECT url, dst FROM ({RESOLVED_SQL})")
def resolved_links(spark: SparkSession, sf: str) -> DataFrame:
    return L.resolved_links(S.pages(spark, sf)).select("url", "dst")


@register("url_parts", sql=f"""
SELECT page_id, {Q.host('url')} AS host, {Q.port('url')} AS port FROM pages""")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    return S.pages(spark, sf).select("page_id", U.host(u).alias("host"),
                                     U.port(u).alias("port"))


@register("doc_ids", sql="""
WITH firsts AS (SELECT url, min(page_id) AS first_id FROM pages GROUP BY url),
h AS (SELECT url, sha256(url) AS hash,
             row_number() OVER (PARTITION BY sha256(url) ORDER BY first_id) AS rn
      FROM firsts)
SELECT url, hash || CASE WHEN rn = 1 THEN '' ELSE '_' || CAST(rn - 2 AS VARCHAR) END
       || '.html' AS doc_id
FROM h""")
def doc_ids(spark: SparkSession, sf: str) -> DataFrame:
    return L.doc_ids(S.pages(spark, sf))


# ---------------------------------------------------------------- text -----

@register("page_text", sql=f"""
SELECT page_id, sha256({Q.visible_text('html')}) AS text_hash FROM pages""")
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return S.pages(spark, sf).select(
        "page_id", F.sha2(H.visible_text(F.col("html")), 256).alias("text_hash"))


@register("page_titles", sql=f"""
SELECT page_id, {Q.index_title('html')} AS title FROM pages""")
def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    return S.pages(spark, sf).select("page_id",
                                     H.index_title(F.col("html")).alias("title"))


@register("clean_titles", sql=f"""
SELECT page_id, {Q.clean_title(Q.raw_title('html'))} AS title FROM pages""")
def clean_titles(spark: SparkSession, sf: str) -> DataFrame:
    return S.pages(spark, sf).select(
        "page_id", H.clean_title(H.raw_title(F.col("html"))).alias("title"))


@register("tokens", sql=f"""
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
       CAST(len(list_distinct(toks)) AS BIGINT) AS n_distinct
FROM (SELECT doc_id, {Q.punct_tokens('text')} AS toks FROM documents)""")
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    toks = TX.punct_tokens(F.col("text"))
    return (S.documents(spark, sf).select("doc_id", toks.alias("toks"))
            .select("doc_id", F.size("toks").cast("long").alias("n_tokens"),
                    F.size(F.array_distinct("toks")).cast("long").alias("n_distinct")))


_POP_SQL = (f"TRY_CAST(substring({Q.strip_ws(f'regexp_extract(html, {Q.lit(H.POPULARITY_RE)}, 1)')}, 2) "
            f"AS INTEGER)")


@register("title_weights", sql=f"""
SELECT page_id, 99999 - coalesce({_POP_SQL}, 99999) AS weight FROM pages""")
def title_weights(spark: SparkSession, sf: str) -> DataFrame:
    return S.pages(spark, sf).select("page_id",
                                     H.title_weight(F.col("html")).alias("weight"))


_IMG_SQL = (f"coalesce(nullif(regexp_extract(html, {Q.lit(H.OG_IMAGE_RE)}, 1), ''), "
            f"nullif(regexp_extract(html, {Q.lit(H.OG_IMAGE_REV_RE)}, 1), ''))")


@register("page_images", sql=f"""
SELECT url, image_url FROM (SELECT url, {_IMG_SQL} AS image_url FROM pages)
WHERE image_url IS NOT NULL""")
def page_images(spark: SparkSession, sf: str) -> DataFrame:
    return (S.pages(spark, sf)
            .select("url", H.og_image(F.col("html")).alias("image_url"))
            .where(F.col("image_url").isNotNull()))


# Entry pages built from the parts: titles with the site's suffix, a popularity
# number (none for every fifth), a preview image in either order of attributes,
# links that the strict filter drops. The given pages have none of these.
ENTRY_PAGES_SQL = """
SELECT p_partkey AS page_id, 'http://site.example/entry/' || p_partkey AS url,
  '<html><head><title> ' || p_name || CASE WHEN p_partkey % 3 = 0 THEN ' | Manga (' || p_brand || ')'
    WHEN p_partkey % 3 = 1 THEN ' (' || p_brand || ')' ELSE '' END || ' - MyAnimeList.net </title>' ||
  CASE WHEN p_partkey % 2 = 0 THEN '<meta property="og:image" content="http://img.example/' || p_size || '.jpg">'
    WHEN p_partkey % 7 = 0 THEN '' ELSE '<meta content="http://img.example/' || p_size || '.png" property="og:image">' END ||
  '</head><body><span class="numbers popularity">Popularity <strong>' ||
  CASE WHEN p_partkey % 5 = 0 THEN 'N/A' ELSE '#' || p_size END || '</strong></span>' ||
  '<a href="/entry/' || (p_partkey + 1) || '">next</a><a href="#top">top</a>' ||
  '<a href="/wiki/Special:Random">any</a><a href="/Category:' || p_size || '">more</a></body></html>' AS html
FROM part"""


def entry_pages(spark: SparkSession, sf: str) -> DataFrame:
    part = S.table(spark, sf, "part")
    expr = ENTRY_PAGES_SQL.split(" AS url,", 1)[1].rsplit(" AS html", 1)[0]
    return part.select(F.col("p_partkey").alias("page_id"),
                       F.expr("'http://site.example/entry/' || p_partkey").alias("url"),
                       F.expr(expr).alias("html"))


@register("entry_fields", sql=f"""
SELECT page_id, {Q.index_title('html')} AS title, {Q.clean_title(Q.raw_title('html'))} AS clean,
  99999 - coalesce({_POP_SQL}, 99999) AS weight, {_IMG_SQL} AS image_url,
  len(list_filter({Q.anchor_hrefs('html')}, lambda h: h <> '' AND {' AND '.join(f"NOT contains(h, {Q.lit(p)})" for p in STRICT_LINK_PATTERNS)}))::INTEGER AS n_strict
FROM ({ENTRY_PAGES_SQL})""")
def entry_fields(spark: SparkSession, sf: str) -> DataFrame:
    """T8-T12, F1 on entry pages: title, dictionary title, weight, image, links
    left by the strict filter."""
    html = F.col("html")
    strict = F.filter(H.anchor_hrefs(html), L.strict_ok)
    return entry_pages(spark, sf).select(
        "page_id", H.index_title(html).alias("title"), H.clean_title(H.raw_title(html)).alias("clean"),
        H.title_weight(html).alias("weight"), H.og_image(html).alias("image_url"),
        F.size(strict).alias("n_strict"))


@register("token_rows", sql=f"""
SELECT item_id, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS token
FROM (SELECT item_id, {Q.punct_tokens('text')} AS toks FROM benchmark)""")
def token_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The tokens themselves, in order."""
    return S.table(spark, sf, "benchmark").select(
        "item_id", F.posexplode(TX.punct_tokens(F.col("text"))).alias("pos", "token"))
