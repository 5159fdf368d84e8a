"""Request-log replays, debounce and stream ingestion: R1-R5, S11."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import sqlfrag as Q
from quarry.plans.corpus import RESOLVED_SQL
from quarry.plans.registry import register
from quarry.sources import tables as S
from quarry.streaming import debounce as DB
from quarry.session import scratch_path
from quarry.streaming import ingest as IG
from quarry.streaming import replay as RP
from quarry.streaming import tables as IT

DEBOUNCE_GAP = "10 minutes"


def _case_sql(col: str, mapping: dict) -> str:
    parts = " ".join(f"WHEN {Q.lit(k)} THEN {Q.lit(v) if v is not None else 'NULL'}"
                     for k, v in mapping.items())
    return f"CASE {col} {parts} END"


@register("mode_replay", sql=f"""
SELECT event_id,
       coalesce(last_value(m IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'both') AS mode
FROM (SELECT *, {_case_sql('event_type', RP.MODE_OF_EVENT)} AS m FROM events)""")
def mode_replay(spark: SparkSession, sf: str) -> DataFrame:
    return RP.mode_replay(S.events(spark, sf))


@register("query_replay", sql="""
SELECT conv_id, turn,
       last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (
         PARTITION BY conv_id ORDER BY turn
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS q
FROM conversations""")
def query_replay(spark: SparkSession, sf: str) -> DataFrame:
    """R2 over the conversation log: each turn is a request of the session
    (conversation); assistant turns carry no query, so the last user query
    is searched again."""
    c = S.table(spark, sf, "conversations")
    req = c.select(F.col("conv_id").alias("session"), F.col("turn").alias("seq"),
                   F.when(F.col("role") == "user", F.col("text")).alias("q"))
    r = RP.query_replay(req)
    return r.select(F.col("session").alias("conv_id"), F.col("seq").alias("turn"), "q")


@register("query_replay_home", sql="""
WITH e AS (
  SELECT event_id, user_id, ts, event_type = 'view' AS home,
         CASE WHEN event_type IN ('click', 'purchase') THEN CAST(floor(value) AS BIGINT) END AS q FROM events),
s AS (SELECT *, sum(CASE WHEN home THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visit FROM e)
SELECT event_id, CASE WHEN home THEN NULL ELSE last_value(q IGNORE NULLS) OVER (
         PARTITION BY user_id, visit ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS q
FROM s""")
def query_replay_home(spark: SparkSession, sf: str) -> DataFrame:
    """R2 over the request log: clicks and purchases search for their value,
    a view opens the home page, which forgets the last query."""
    e = S.events(spark, sf)
    q = F.when(F.col("event_type").isin("click", "purchase"), F.floor("value").cast("long").cast("string"))
    req = e.select(F.col("user_id").alias("session"), F.struct("ts", "event_id").alias("seq"), q.alias("q"),
                   (F.col("event_type") == "view").alias("home"))
    r = RP.query_replay(req)
    return r.select("seq.event_id", F.col("q").cast("long").alias("q"))


@register("page_replay", sql=f"""
WITH RECURSIVE e AS (
  SELECT event_id, user_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         {_case_sql('event_type', RP.PAGE_ACTION_OF_EVENT)} AS act,
         CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) END AS total
  FROM events),
w AS (SELECT *, last_value(total IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur_total FROM e),
w2 AS (SELECT *, CASE WHEN cur_total IS NULL THEN 1
                      ELSE greatest(CAST(ceil(cur_total / 10) AS BIGINT), 1) END AS last FROM w),
walk(user_id, rn, page) AS (
  SELECT user_id, rn, CASE WHEN act IN ('query', 'first') THEN 1
                           WHEN act IN ('next', 'prev') THEN least(last, greatest(1, 1 + CASE act WHEN 'next' THEN 1 ELSE -1 END))
                           ELSE 1 END
  FROM w2 WHERE rn = 1
  UNION ALL
  SELECT w2.user_id, w2.rn,
         CASE WHEN w2.act IN ('query', 'first') THEN 1
              WHEN w2.act IN ('next', 'prev') THEN least(w2.last, greatest(1, walk.page + CASE w2.act WHEN 'next' THEN 1 ELSE -1 END))
              ELSE walk.page END
  FROM walk JOIN w2 ON w2.user_id = walk.user_id AND w2.rn = walk.rn + 1)
SELECT w2.event_id, CAST(CASE WHEN w2.cur_total IS NOT NULL THEN walk.page END AS INTEGER) AS page_no
FROM w2 JOIN walk ON walk.user_id = w2.user_id AND walk.rn = w2.rn""")
def page_replay(spark: SparkSession, sf: str) -> DataFrame:
    return RP.page_replay(S.events(spark, sf))


@register("debounced_events", sql="""
WITH e AS (
  SELECT user_id, ts, event_id, event_type,
         CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 10 MINUTE
              THEN 1 ELSE 0 END AS new_burst
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new_burst) OVER (PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS burst FROM e)
SELECT user_id, min(ts) AS start_ts, arg_max(event_type, (ts, event_id)) AS event_type
FROM s GROUP BY user_id, burst""")
def debounced_events(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts separated by 10 minutes of quiet; the burst's last request
    is the one that runs."""
    return DB.debounce(S.events(spark, sf), DEBOUNCE_GAP)


@register("stream_ingest", sql=f"SELECT DISTINCT url AS src, dst FROM ({RESOLVED_SQL})")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The pages table, a file or a folder of files, fed through the
    streaming ingestion (dedup by URL, links out); equals ``distinct_links``."""
    return IG.ingest_to_table(spark, IG.one_table(f"{sf}/pages.parquet"))


@register("ingest_tables", sql=f"""
WITH p AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id NULLS LAST) = 1),
l AS (SELECT DISTINCT url AS src, dst FROM ({RESOLVED_SQL}))
SELECT p.url, length({Q.visible_text('html')}) AS n_chars, coalesce(k.n, 0) AS n_links,
       (SELECT count(*) FROM pages) AS n_rows, (SELECT count(*) FROM p) AS new_pages,
       (SELECT count(*) FROM l) AS links
FROM p LEFT JOIN (SELECT src, count(*) AS n FROM l GROUP BY src) k ON k.src = p.url""")
def ingest_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The pages table through the batched crawl loop: every stored
    page with the size of its text and its links, and the observed counters."""
    base = scratch_path(spark, f"crawl-{uuid.uuid4().hex}")
    IT.ingest_tables(spark, IG.one_table(f"{sf}/pages.parquet"), f"{base}/tables", f"{base}/checkpoint")
    read = lambda kind: IT.read_table(spark, f"{base}/tables", kind)
    links = read("edges").groupBy(F.col("src").alias("url")).agg(F.count(F.lit(1)).alias("n"))
    # a row per batch, summed to one
    sums = read("counters").agg(F.sum("rows").alias("n_rows"), F.sum("new_pages").alias("new_pages"),
                                F.sum("links").alias("links")).first()
    return (read("clean").select("url", F.length("text").cast("long").alias("n_chars"))
            .join(links, "url", "left")
            .select("url", "n_chars", F.coalesce("n", F.lit(0)).alias("n_links"),
                    *[F.lit(v).cast("long").alias(k) for k, v in sums.asDict().items()]))
