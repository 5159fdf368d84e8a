"""Crawl planning as batch jobs.

Fetching is outside the engine: pages, robots rules and delays arrive as
tables. From them we compute what the crawl loop decides one URL at a time:
which discovered URLs are new, allowed and valid, in which order they are
taken, and when each may be fetched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import urls as U
from quarry.functions.constants import DEFAULT_CRAWL_DELAY
from quarry.operators import sequence as SQ
from quarry.session import ensure_checkpoint_dir

ROBOTS_SCHEMA = "domain string, seq int, allow boolean, prefix string"
DELAY_SCHEMA = "domain string, crawl_delay double, req_seconds double, req_count int"


def new_pages(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """URLs not stored yet, each once: ``incoming(url)`` ⋉̸ ``stored(url)``."""
    return incoming.select("url").distinct().join(stored.select("url"), "url", "left_anti")


def seed_order(seeds: DataFrame) -> DataFrame:
    """``seeds(domain, seq, url)`` (sitemap order) → the crawl takes each
    domain's list reversed: ``(domain, url, position)``, 1 = first taken."""
    r = SQ.group_rank(seeds, ["domain"], [F.desc("seq"), F.asc("url")], "position")
    return r.select("domain", "url", "position")


def seed_lists(cached: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """The seeds of all domains ``(domain, seq, url)``: a domain whose
    list is cached keeps it, the others take their sitemap's."""
    fresh = sitemaps.join(cached.select("domain").distinct(), "domain", "left_anti")
    return cached.select("domain", "seq", "url").unionByName(fresh.select("domain", "seq", "url"))


def _path_of(url):
    """Path and query of a URL (what robots rules match against)."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)


def robots_allowed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls(url)`` → ``(url, allowed)``. The rules of the URL's
    host (or of domain ``'*'`` when the host has none) are tried in ``seq``
    order; the first prefix that matches decides; no match allows. The prefix
    ``*`` matches every path, and so does an empty one, which always allows.

    A URL's path is cut to the lengths that its host's prefixes have (one array
    per host), and the cut paths join the rules on (host, prefix): no URL meets
    a rule that doesn't match. The rules of ``'*'``, one robots file, become a
    literal of the plan."""
    u = urls.select("url").distinct().withColumn("host", U.host(F.col("url")))
    p = _path_of(F.col("url"))
    u = u.withColumn("path", F.when(p == "", F.lit("/")).otherwise(p))
    any_path = F.col("prefix").isin("", "*")
    rule = rules.select("domain", "seq", F.when(any_path, "").otherwise(F.col("prefix")).alias("prefix"),
                        F.when(F.col("prefix") == "", True).otherwise(F.col("allow")).alias("allow"))
    own = rule.where(F.col("domain") != "*").withColumnRenamed("domain", "host")
    lengths = own.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    # of equal prefixes the first decides
    first = own.groupBy("host", "prefix").agg(F.min(F.struct("seq", "allow")).alias("r"))
    u = u.join(lengths, "host", "left")
    cut = (u.where(F.col("lengths").isNotNull())
           .select("url", "host", "path", F.explode("lengths").alias("n"))
           .where(F.col("n") <= F.length("path"))
           .select("url", "host", F.expr("left(path, n)").alias("prefix")))
    decided = (cut.join(first, ["host", "prefix"])
               .groupBy("url").agg(F.min("r").alias("r")).select("url", F.col("r.allow").alias("decided")))
    shared = rule.where(F.col("domain") == "*").orderBy("seq").collect()  # one robots file
    other = F.coalesce(*[F.when(F.col("path").startswith(r.prefix), F.lit(r.allow)) for r in shared],
                       F.lit(True))
    return (u.join(decided, "url", "left")
            .select("url", F.when(F.col("lengths").isNull(), other)
                    .otherwise(F.coalesce("decided", F.lit(True))).alias("allowed")))


def frontier(links: DataFrame, seen: DataFrame, rules: DataFrame,
             budget: int = -1, hosts: tuple[str, ...] = ()) -> DataFrame:
    """Next URLs to fetch.

    ``links(page_id, url, pos, dst)`` are the resolved links in discovery
    order (page, then position on the page). A URL is taken at its first
    discovery, unless already seen (F6), its port is invalid (F3) or robots
    forbid it (F4), or its ``content_type``, where ``links`` has that column
    and it is known, is not HTML (F5). Links to the linking page's own host,
    or, if ``hosts`` is given, to hosts that one of these patterns finds, are
    preferred and taken first, newest discovery first (pushed on the stack); the others
    wait at the bottom, oldest first (W9). ``budget`` > 0 keeps that many
    (F9). Returns ``(url, host, preferred, position)``.
    """
    if "content_type" in links.columns:
        links = links.where(F.coalesce(F.contains("content_type", F.lit("text/html")), F.lit(True)))
    first = (links.groupBy(F.col("dst").alias("url"))
             .agg(F.min(F.struct("page_id", "pos", "url")).alias("d"))
             .select("url", F.col("d.page_id").alias("page_id"), F.col("d.pos").alias("pos"),
                     F.col("d.url").alias("src")))
    # the candidate set is read twice (robots decision, final rows): written
    # once to the checkpoint folder — it is also the frontier the crawl keeps
    ensure_checkpoint_dir(links.sparkSession)
    cand = (first.join(seen.select("url"), "url", "left_anti")
            .where(U.port_ok(F.col("url")))
            .checkpoint(eager=True))
    allowed = robots_allowed(cand.select("url"), rules).where("allowed").select("url")
    cand = (cand.join(allowed, "url", "left_semi")
            .withColumn("host", U.host(F.col("url")))
            .withColumn("preferred", F.col("host") == U.host(F.col("src"))))
    if hosts:
        cand = cand.withColumn("preferred", F.col("host").rlike("|".join(f"(?:{h})" for h in hosts)))
    # stack order: preferred newest-first, then the rest oldest-first
    key_page = F.when(F.col("preferred"), -F.col("page_id")).otherwise(F.col("page_id"))
    key_pos = F.when(F.col("preferred"), -F.col("pos")).otherwise(F.col("pos"))
    ranked = SQ.global_rank(cand, [F.desc("preferred"), key_page, key_pos, F.asc("url")],
                            "position")
    out = ranked.select("url", "host", "preferred", "position")
    if budget > 0:
        out = out.where(F.col("position") <= budget)
    return out


def domain_delay(delays: DataFrame) -> DataFrame:
    """``greatest(robots delay or default, seconds / requests)`` per domain."""
    crawl = F.coalesce(F.nullif(F.col("crawl_delay"), F.lit(0.0)), F.lit(DEFAULT_CRAWL_DELAY))
    rate = F.coalesce(F.col("req_seconds") / F.col("req_count"), F.lit(0.0))
    return delays.select("domain", F.greatest(crawl, rate).alias("delay"))


def fetch_schedule(front: DataFrame, delays: DataFrame) -> DataFrame:
    """Planned fetch time of each frontier URL as an offset in seconds:
    ``(index within its host - 1) * delay of the host``.
    ``front(url, host, position)`` → ``(url, host, offset_seconds)``."""
    d = domain_delay(delays)
    own = d.where(F.col("domain") != "*").withColumnRenamed("domain", "host")
    # the '*' row is one value: read it once
    default = d.where(F.col("domain") == "*").select("delay").first()
    default_delay = default[0] if default else DEFAULT_CRAWL_DELAY
    r = SQ.group_rank(front.select("url", "host", "position"), ["host"], ["position"], "idx")
    return (r.join(own, "host", "left")
            .select("url", "host",
                    ((F.col("idx") - 1) * F.coalesce(F.col("delay"), F.lit(default_delay)))
                    .alias("offset_seconds")))


def host_counts(pages: DataFrame) -> DataFrame:
    """Stored pages per host."""
    return (pages.select(U.host(F.col("url")).alias("host"))
            .groupBy("host").agg(F.count(F.lit(1)).alias("n_pages")))
