"""Index and search queries: X1-X9, A9-A11, A15, W1-W3, J3, J4, J8, U1, U2."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions.constants import (BM25_B, BM25_K1, FAILED_STATUS, PAGE_LEN,
                                       REDIRECT_PREFIX, SCORE_WEIGHTS, SUGGEST_SIZE)
from quarry.functions.porter import stem_sql
from quarry.operators import index as IX
from quarry.operators import search as SE
from quarry.operators import stored_index as SI
from quarry.plans import sqlfrag as Q
from quarry.plans.registry import register
from quarry.session import path_exists, remove_path, scratch_path
from quarry.sources import tables as S


def kept_path(spark: SparkSession, table: DataFrame, name: str) -> str:
    """A folder of this application for what is derived from a table in its
    present state: path, size and time of its files name it."""
    facts = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    state = facts.distinct().agg(F.bit_xor(F.xxhash64(*facts.columns))).first()[0]
    return scratch_path(spark, f"{name}-{spark.sparkContext.applicationId}-{(state or 0) & (2 ** 64 - 1):016x}")


_OPEN: dict[str, IX.Index] = {}  # by folder; nobody writes to these after the build


def stored_index(spark: SparkSession, sf: str, stem: bool = False,
                 which: tuple[str, ...] = ("title", "content")) -> IX.Index:
    """The stored index of the pages, built by the first query that asks and
    reopened by the others; ``which`` names its fields."""
    pages = S.pages(spark, sf)
    path = kept_path(spark, pages, "-".join(["stems" if stem else "index", *which]))
    if path not in _OPEN:
        if not path_exists(spark, f"{path}/commits"):
            remove_path(spark, path)
            SI.create_index(path, pages, stem=stem, which=which)
        _OPEN[path] = SI.open_index(spark, path)
    return _OPEN[path]


def title_index(spark: SparkSession, sf: str) -> IX.Index:
    """The index of the titles alone: a search in titles needs no more."""
    return stored_index(spark, sf, which=("title",))


def title_query_table(spark: SparkSession, sf: str, index: IX.Index | None = None) -> DataFrame:
    """The query workload: the stored title of every page of the index is a
    query (``query_id`` = page_id), so each query has at least one hit and the
    workload grows with the corpus. A query that searches another index than
    that of the titles takes them from there."""
    docs = (index or title_index(spark, sf)).docs
    return docs.select(F.col("page_id").alias("query_id"), F.col("title").alias("query"))


def title_terms(spark: SparkSession, sf: str, index: IX.Index | None = None) -> DataFrame:
    """The query rows of the workload."""
    return SE.analyze_groups(SE.title_queries(title_query_table(spark, sf, index)), stem=False,
                             dedup_groups=False)


# -------------------------------------------------------------- oracle SQL --

def _resolved_sql() -> str:
    from quarry.plans.corpus import RESOLVED_SQL
    return RESOLVED_SQL


# A URL stored twice is indexed once, with the row of its lowest page_id.
ONE_PER_URL_SQL = ("SELECT * FROM pages QUALIFY "
                   "row_number() OVER (PARTITION BY url ORDER BY page_id NULLS LAST, html) = 1")

TITLE_FIELDS_SQL = f"""
SELECT page_id, url, coalesce({Q.index_title('html')}, '') AS title FROM ({ONE_PER_URL_SQL})"""

TITLE_POSTINGS_SQL = f"""
SELECT term, url, CAST(count(*) AS BIGINT) AS tf, any_value(len) AS len FROM (
  SELECT url, len(toks) AS len, unnest(toks) AS term FROM (
    SELECT url, {Q.word_tokens('title')} AS toks FROM ({TITLE_FIELDS_SQL})))
GROUP BY term, url"""

CONTENT_POSTINGS_SQL = f"""
SELECT term, url, CAST(count(*) AS BIGINT) AS tf, any_value(len) AS len FROM (
  SELECT url, len(toks) AS len, unnest(toks) AS term FROM (
    SELECT url, {Q.content_tokens(Q.visible_text('html'))} AS toks FROM ({ONE_PER_URL_SQL})))
GROUP BY term, url"""


def bm25_sql(idf: str, tf: str, length: str, avg: str) -> str:
    return (f"({idf}) * ({tf} * {BM25_K1 + 1}) / ({tf} + {BM25_K1} * "
            f"((1 - {BM25_B}) + {BM25_B} * {length} / {avg}))")


def title_hits_sql(mode: str, ranks_sql: str | None = None) -> str:
    """Per (query, url) scores of the title-query workload (AND of the
    distinct title terms) — the oracle of ``search_*``."""
    a, b = SCORE_WEIGHTS[mode]
    pr_join = f"JOIN ({ranks_sql}) r ON r.url = m.url" if a else ""
    pr_term = f"{a} * r.pr * m.n_hit + " if a else ""
    return f"""
WITH post AS ({TITLE_POSTINGS_SQL}),
dfq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
st AS (SELECT count(*) AS n, sum(len(toks)) / count(*) AS avg_len FROM (
        SELECT {Q.word_tokens('title')} AS toks FROM ({TITLE_FIELDS_SQL}))),
q AS (SELECT DISTINCT query_id, term FROM (
        SELECT page_id AS query_id, unnest({Q.word_tokens('title')}) AS term
        FROM ({TITLE_FIELDS_SQL}))),
qn AS (SELECT query_id, count(*) AS n_terms FROM q GROUP BY query_id),
m AS (SELECT q.query_id, p.url, count(*) AS n_hit,
             sum({bm25_sql('ln(st.n / (dfq.df + 1)) + 1', 'p.tf', 'p.len', 'st.avg_len')}) AS s
      FROM q JOIN post p ON p.term = q.term JOIN dfq ON dfq.term = q.term CROSS JOIN st
      GROUP BY q.query_id, p.url)
SELECT m.query_id, m.url, round({pr_term}{b} * m.s, 6) AS score
FROM m JOIN qn ON qn.query_id = m.query_id {pr_join}
WHERE m.n_hit = qn.n_terms"""


def ranked_sql(hits_sql: str) -> str:
    return f"""
SELECT query_id, url, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, url) AS INTEGER) AS rank
FROM ({hits_sql})"""


# ------------------------------------------------------------- queries -----

@register("title_postings", sql=f"SELECT term, url, tf FROM ({TITLE_POSTINGS_SQL})")
def title_postings(spark: SparkSession, sf: str) -> DataFrame:
    return IX.build_index(S.pages(spark, sf), which=("title",)).postings.select("term", "url", "tf")


@register("content_postings", sql=f"SELECT term, url, tf FROM ({CONTENT_POSTINGS_SQL})")
def content_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Content field with stop filter, unstemmed (DuckDB has no stemmer)."""
    ix = IX.build_index(S.pages(spark, sf), stem=False, which=("content",))
    return ix.postings.select("term", "url", "tf")


STEMMED_POSTINGS_SQL = f"""
SELECT stem AS term, url, CAST(sum(tf) AS BIGINT) AS tf, any_value(len) AS len
FROM ({stem_sql(CONTENT_POSTINGS_SQL)}) GROUP BY stem, url"""


@register("stemmed_postings", sql=f"SELECT term, url, tf FROM ({STEMMED_POSTINGS_SQL})")
def stemmed_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Content field as indexed: stop filter + Porter stemming."""
    ix = IX.build_index(S.pages(spark, sf), stem=True, which=("content",))
    return ix.postings.select("term", "url", "tf")


@register("field_stats", sql=f"""
SELECT 'title' AS field, CAST(count(*) AS BIGINT) AS n_docs,
       round(sum(len({Q.word_tokens('title')})) / count(*), 6) AS avg_len
FROM ({TITLE_FIELDS_SQL})
UNION ALL
SELECT 'content', CAST(count(*) AS BIGINT),
       round(sum(len({Q.content_tokens(Q.visible_text('html'))})) / count(*), 6)
FROM ({ONE_PER_URL_SQL})""")
def field_stats(spark: SparkSession, sf: str) -> DataFrame:
    ix = IX.build_index(S.pages(spark, sf), stem=False)
    return ix.field_stats.select("field", "n_docs", F.round("avg_len", 6).alias("avg_len"))


@register("search_bm25", sql=ranked_sql(title_hits_sql("bm25")))
def search_bm25(spark: SparkSession, sf: str) -> DataFrame:
    return SE.search(title_query_table(spark, sf), title_index(spark, sf), mode="bm25")


def _ranks(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.plans.graph import page_ranks
    return page_ranks(spark, sf)


def _ranks_sql() -> str:
    from quarry.plans.graph import page_ranks_sql
    return page_ranks_sql()


@register("search_pagerank", sql=ranked_sql(title_hits_sql("pagerank", _ranks_sql())))
def search_pagerank(spark: SparkSession, sf: str) -> DataFrame:
    """PageRank-only scoring (added once per matching term)."""
    return SE.search(title_query_table(spark, sf), title_index(spark, sf),
                     mode="pagerank", ranks=_ranks(spark, sf))


@register("search_both", sql=ranked_sql(title_hits_sql("both", _ranks_sql())))
def search_both(spark: SparkSession, sf: str) -> DataFrame:
    """100000 * pagerank + 1.5 * bm25 per matching term."""
    return SE.search(title_query_table(spark, sf), title_index(spark, sf),
                     mode="both", ranks=_ranks(spark, sf))


# ----------------------------------------------------- paging and top-n ----

def _first_page(spark: SparkSession, sf: str) -> DataFrame:
    return SE.first_hits(title_terms(spark, sf), title_index(spark, sf), PAGE_LEN)


@register("search_topn", sql=f"""
SELECT query_id, url, rank FROM ({ranked_sql(title_hits_sql("bm25"))}) WHERE rank <= {PAGE_LEN}""")
def search_topn(spark: SparkSession, sf: str) -> DataFrame:
    """The first 10 hits per query, straight from the scores (a rank-limited
    window, WindowGroupLimit in the plan); no hit beyond is ranked."""
    return _first_page(spark, sf).select("query_id", "url", "rank")


@register("result_page", sql=f"""
SELECT query_id, CAST(ceil(rank / {PAGE_LEN}) AS INTEGER) AS page_no,
       count(*) OVER (PARTITION BY query_id) AS total, url, rank
FROM ({ranked_sql(title_hits_sql("bm25"))})""")
def result_page(spark: SparkSession, sf: str) -> DataFrame:
    """Every hit with its page number and the query's total."""
    ranked, members = SE.ranked_classes(title_terms(spark, sf), title_index(spark, sf))
    return (SE.for_members(SE.with_pages(ranked), members.where(F.col("query_id").isNotNull()))
            .select("query_id", "page_no", "total", "url", "rank"))


# ------------------------------------------------- expansion and upgrade ----

def page_entries(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.operators import suggest as SG
    d = SG.title_dictionary(S.pages(spark, sf))
    return d.select(F.col("title").alias("key"), "title", "weight")


def expanded_groups(spark: SparkSession, sf: str, index: IX.Index | None = None) -> DataFrame:
    """Each query becomes (its whole-string suggestions, each an AND
    group in the title field) OR (the query as an AND group in content).
    ``(query_id, group_id, field, text)``; the content group's number is k."""
    from quarry.operators import suggest as SG
    q = title_query_table(spark, sf, index)
    sugg = SG.suggestion_groups(q, page_entries(spark, sf))
    content = q.select("query_id", F.lit(SUGGEST_SIZE).alias("group_id"),
                       F.lit("content").alias("field"), F.col("query").alias("text"))
    return sugg.unionByName(content)


def expanded_terms(spark: SparkSession, sf: str, index: IX.Index | None = None) -> DataFrame:
    return SE.analyze_groups(expanded_groups(spark, sf, index), stem=False)


def both_fields_index(spark: SparkSession, sf: str) -> IX.Index:
    return stored_index(spark, sf)


def page_entries_sql() -> str:
    from quarry.functions.constants import POPULARITY_FALLBACK as FB
    pop = (f"TRY_CAST(substring({Q.strip_ws(f'regexp_extract(html, {Q.lit(H.POPULARITY_RE)}, 1)')}, 2) "
           f"AS INTEGER)")
    return f"""
SELECT title AS key, title, arg_max(weight, page_id) AS weight FROM (
  SELECT page_id, {Q.clean_title(Q.raw_title('html'))} AS title,
         {FB} - coalesce({pop}, {FB}) AS weight FROM pages)
WHERE title IS NOT NULL GROUP BY title"""


def expanded_sql(stems: bool = False) -> str:
    """Oracle rows (query_id, group_id, field, term) of the expanded queries."""
    from quarry.plans.dictionary import brute_suggest_sql
    frag = f"SELECT page_id AS fragment_id, {Q.index_title('html')} AS fragment FROM ({ONE_PER_URL_SQL})"
    sugg = brute_suggest_sql(frag, entries_sql=page_entries_sql())
    terms = """
  SELECT query_id, group_id, field,
         unnest(CASE WHEN field = 'title' THEN {title} ELSE {content} END) AS term FROM g""".format(
        title=Q.word_tokens("text"), content=Q.content_tokens("text"))
    if stems:
        terms = f"""
  SELECT query_id, group_id, field, CASE WHEN field = 'title' THEN term ELSE stem END AS term
  FROM ({stem_sql(terms)})"""
    return f"""
WITH g AS (
  SELECT fragment_id AS query_id, rank - 1 AS group_id, 'title' AS field, title AS text
  FROM ({sugg})
  UNION ALL
  SELECT page_id, 0, 'title', {Q.index_title('html')} FROM ({ONE_PER_URL_SQL})
  WHERE {Q.index_title('html')} IS NOT NULL AND page_id NOT IN (SELECT fragment_id FROM ({sugg}))
  UNION ALL
  SELECT page_id, {SUGGEST_SIZE}, 'content', {Q.index_title('html')} FROM ({ONE_PER_URL_SQL})
  WHERE {Q.index_title('html')} IS NOT NULL),
r AS (SELECT DISTINCT query_id, group_id, field, term FROM ({terms})),
sig AS (SELECT query_id, group_id, field, list_sort(list(term)) AS sig FROM r
        GROUP BY query_id, group_id, field),
keep AS (SELECT query_id, min(group_id) AS group_id FROM sig GROUP BY query_id, field, sig)
SELECT r.query_id, CAST(r.group_id AS INTEGER) AS group_id, r.field, r.term
FROM r JOIN keep ON keep.query_id = r.query_id AND keep.group_id = r.group_id"""


def expanded_hits_sql(mode: str = "bm25", stems: bool = False, ranks_sql: str | None = None) -> str:
    """Per (query, url) scores of the expanded queries (both fields)."""
    a, b = SCORE_WEIGHTS[mode]
    pr_join = f"JOIN ({ranks_sql}) r ON r.url = m.url" if a else ""
    pr_term = f"{a} * r.pr * qn.n_terms + " if a else ""
    post = f"""
SELECT 'title' AS field, term, url, tf, len FROM ({TITLE_POSTINGS_SQL})
UNION ALL SELECT 'content', term, url, tf, len FROM ({STEMMED_POSTINGS_SQL if stems else CONTENT_POSTINGS_SQL})"""
    return f"""
WITH post AS ({post}),
dfq AS (SELECT field, term, count(*) AS df FROM post GROUP BY field, term),
st AS (SELECT field, (SELECT count(DISTINCT url) FROM pages) AS n,
         sum(len) / (SELECT count(DISTINCT url) FROM pages) AS avg_len
       FROM (SELECT DISTINCT field, url, len FROM post) GROUP BY field),
q AS ({expanded_sql(stems)}),
qn AS (SELECT query_id, group_id, field, count(*) AS n_terms FROM q GROUP BY ALL),
m AS (SELECT q.query_id, q.group_id, p.url, count(*) AS n_hit,
             sum({bm25_sql('ln(st.n / (dfq.df + 1)) + 1', 'p.tf', 'p.len', 'st.avg_len')}) AS s
      FROM q JOIN post p ON p.field = q.field AND p.term = q.term
      JOIN dfq ON dfq.field = q.field AND dfq.term = q.term JOIN st ON st.field = q.field
      GROUP BY q.query_id, q.group_id, p.url)
SELECT m.query_id, m.url, round(sum({pr_term}{b} * m.s), 6) AS score
FROM m JOIN qn ON qn.query_id = m.query_id AND qn.group_id = m.group_id {pr_join}
WHERE m.n_hit = qn.n_terms
GROUP BY m.query_id, m.url"""


@register("expanded_queries", sql=expanded_sql())
def expanded_queries(spark: SparkSession, sf: str) -> DataFrame:
    t = expanded_terms(spark, sf)
    return t.select("query_id", F.col("group_id").cast("int").alias("group_id"), "field", "term")


@register("search_expanded", sql=ranked_sql(expanded_hits_sql()))
def search_expanded(spark: SparkSession, sf: str) -> DataFrame:
    """``(suggestions) OR content:(query)`` scored with BM25."""
    ix = both_fields_index(spark, sf)
    return SE.search_terms(expanded_terms(spark, sf, ix), ix, mode="bm25")


def upgraded_sql(a: str, b: str) -> str:
    """Ranked hits ``a`` with those of ``b`` moved first."""
    return f"""
WITH a AS ({ranked_sql(a)}),
b AS ({b}),
m AS (SELECT a.query_id, a.url, a.rank, b.url IS NOT NULL AS exact
      FROM a LEFT JOIN (SELECT DISTINCT query_id, url FROM b) b
      ON a.query_id = b.query_id AND a.url = b.url)
SELECT query_id, url, exact,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, rank) AS INTEGER) AS rank
FROM m"""


@register("search_upgrade", sql=upgraded_sql(expanded_hits_sql(), title_hits_sql("bm25")))
def search_upgrade(spark: SparkSession, sf: str) -> DataFrame:
    """Expanded results with the plain title hits moved first."""
    ix = both_fields_index(spark, sf)
    return SE.for_members(*SE.upgraded_classes(expanded_terms(spark, sf, ix), title_terms(spark, sf, ix), ix))


@register("search_submit", sql=f"""
SELECT query_id, url, rank FROM ({upgraded_sql(expanded_hits_sql("both", True, _ranks_sql()),
                                               title_hits_sql("bm25"))})""")
def search_submit(spark: SparkSession, sf: str) -> DataFrame:
    """X7/X9 as a user calls it: upgraded, in mode "both", the content by its
    stems."""
    ix = stored_index(spark, sf, stem=True)
    return SE.submit(title_query_table(spark, sf, ix), ix,
                     page_entries(spark, sf), ranks=_ranks(spark, sf), upgrade=True)


@register("requested_pages", sql=f"""
WITH h AS ({ranked_sql(title_hits_sql("bm25"))}),
t AS (SELECT query_id, count(*) AS total FROM h GROUP BY query_id),
r AS (SELECT query_id, unnest([-1, 1, 2, 1000000]) AS asked FROM (
        SELECT DISTINCT page_id AS query_id FROM ({TITLE_FIELDS_SQL}))),
p AS (SELECT query_id, asked, coalesce(total, 0) AS total,
        CAST(least(greatest(asked, 1), greatest(ceil(coalesce(total, 0) / {PAGE_LEN}), 1)) AS INTEGER) AS page_no
      FROM r LEFT JOIN t USING (query_id))
SELECT p.query_id, p.asked, p.page_no, CAST(p.total AS BIGINT) AS total, h.url, h.rank
FROM p LEFT JOIN h ON h.query_id = p.query_id AND CAST(ceil(h.rank / {PAGE_LEN}) AS INTEGER) = p.page_no""")
def requested_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages asked for by number, clamped at both ends."""
    asked = F.explode(F.array(*[F.lit(n) for n in (-1, 1, 2, 1_000_000)]))
    requests = title_query_table(spark, sf).select("query_id", asked.alias("page"))
    # pages are cut per class of queries; the request's own id and the number
    # asked for ride along
    ranked, members = SE.ranked_classes(title_terms(spark, sf), title_index(spark, sf))
    asked = requests.join(members, "query_id", "left").select(
        F.col("qclass").alias("query_id"), "page", F.col("query_id").alias("own"), F.col("page").alias("asked"))
    return SE.page_slice(ranked, asked).select(F.col("own").alias("query_id"), "asked", "page_no", "total", "url", "rank")


@register("search_segments", sql=f"""
WITH kept AS (SELECT * FROM ({ONE_PER_URL_SQL}) WHERE page_id % 7 <> 3 OR page_id % 14 = 3),
p AS (SELECT term, url, count(*) AS tf FROM (
  SELECT url, unnest({Q.word_tokens(f"coalesce({Q.index_title('html')}, '')")}) AS term FROM kept)
  GROUP BY term, url)
SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM p GROUP BY term""")
def search_segments(spark: SparkSession, sf: str) -> DataFrame:
    """An index stored in two deliveries, some pages deleted, half of those
    delivered again, reopened: document frequency and occurrences per term."""
    pages = S.pages(spark, sf)
    first = IX.one_per_url(pages).drop("_copies")  # the row of a URL does not depend on deliveries
    path = scratch_path(spark, f"segments-{uuid.uuid4().hex}")
    SI.create_index(path, first.where(F.col("page_id") % 2 == 0), stem=False, which=("title",))
    SI.add_pages(path, first.where(F.col("page_id") % 2 == 1))
    SI.delete_urls(path, first.where(F.col("page_id") % 7 == 3).select("url"))
    SI.add_pages(path, first.where(F.col("page_id") % 14 == 3))
    ix = SI.open_index(spark, path)
    occurrences = ix.postings.groupBy("field", "term").agg(F.sum("tf").alias("tf"))
    return ix.doc_freq.join(occurrences, ["field", "term"]).select("term", "df", "tf")


@register("result_view", sql=f"""
WITH h AS ({ranked_sql(title_hits_sql("bm25"))}),
img AS (SELECT url, image_url FROM (
  SELECT url, coalesce(nullif(regexp_extract(html, {Q.lit(H.OG_IMAGE_RE)}, 1), ''),
                       nullif(regexp_extract(html, {Q.lit(H.OG_IMAGE_REV_RE)}, 1), '')) AS image_url
  FROM ({ONE_PER_URL_SQL})) WHERE image_url IS NOT NULL),
d AS ({TITLE_FIELDS_SQL})
SELECT h.query_id, h.rank, d.title, {Q.lit(REDIRECT_PREFIX)} || h.url AS link, img.image_url
FROM h LEFT JOIN d ON d.url = h.url LEFT JOIN img ON img.url = h.url
WHERE h.rank <= {PAGE_LEN}""")
def result_view(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of every query with title, redirect link, image."""
    from quarry.operators import view as V
    docs = title_index(spark, sf).docs
    return V.result_view(_first_page(spark, sf), docs, docs)


def _codes_sql() -> str:
    from quarry.operators.view import HTTP_CODES
    return " UNION ALL ".join(f"SELECT {c} AS status, {Q.lit(t)} AS description" for c, t in HTTP_CODES)


@register("link_health", sql=f"""
WITH u AS (SELECT DISTINCT dst AS url FROM ({_resolved_sql()})),
s AS (SELECT DISTINCT url, 200 AS status FROM pages),
c AS ({_codes_sql()}),
j AS (SELECT u.url, CAST(coalesce(s.status, {FAILED_STATUS}) AS INTEGER) AS status
      FROM u LEFT JOIN s ON s.url = u.url)
SELECT j.url, j.status, j.status = 200 AS ok, c.description FROM j LEFT JOIN c ON c.status = j.status""")
def link_health(spark: SparkSession, sf: str) -> DataFrame:
    """F8: health of every link target; a target that is a stored page is
    known good (200); any other has no successful fetch and counts as 400."""
    from quarry.operators import links as L
    from quarry.operators import view as V
    pages = S.pages(spark, sf)
    urls = L.resolved_links(pages).select(F.col("dst").alias("url")).distinct()
    statuses = pages.select("url", F.lit(200).alias("status")).distinct()
    return V.link_health(urls, statuses)
