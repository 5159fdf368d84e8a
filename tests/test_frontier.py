"""Robots (F4, P8), delays (R7), frontier order (R6, W9), link health (F8)."""
from pyspark.sql import functions as F

from quarry.operators import frontier as FR
from quarry.operators import view as V


def test_robots_first_match(spark):
    rules = spark.createDataFrame([
        ("a.com", 1, True, "/p/ok"), ("a.com", 2, False, "/p/"),        # allow before deny
        ("b.com", 1, False, "/p/"), ("b.com", 2, True, "/p/ok"),        # deny before allow
        ("d.com", 1, False, ""),                                         # empty disallow: allow all
        ("*", 1, False, "/private"),
    ], FR.ROBOTS_SCHEMA)
    urls = spark.createDataFrame([(u,) for u in [
        "http://a.com/p/ok/1", "http://a.com/p/x", "http://b.com/p/ok/1", "http://b.com/q",
        "http://c.com/private/1", "http://c.com/x", "http://d.com/private"]], "url string")
    got = {r.url: r.allowed for r in FR.robots_allowed(urls, rules).collect()}
    assert got == {"http://a.com/p/ok/1": True, "http://a.com/p/x": False,
                   "http://b.com/p/ok/1": False, "http://b.com/q": True,
                   "http://c.com/private/1": False, "http://c.com/x": True,
                   "http://d.com/private": True}


def test_delays_and_schedule(spark):
    d = spark.createDataFrame([("a", 0.0, None, None), ("b", 10.0, None, None), ("c", None, 5.0, 1)],
                              FR.DELAY_SCHEMA)
    got = {r.domain: r.delay for r in FR.domain_delay(d).collect()}
    assert got == {"a": 3.0, "b": 10.0, "c": 5.0}
    front = spark.createDataFrame([("u1", "a", 1), ("u2", "b", 2), ("u3", "a", 3), ("u4", "z", 4)],
                                  "url string, host string, position long")
    sched = {r.url: r.offset_seconds for r in FR.fetch_schedule(front, d).collect()}
    assert sched == {"u1": 0.0, "u3": 3.0, "u2": 0.0, "u4": 0.0}


def test_frontier_order(spark):
    links = spark.createDataFrame([
        (1, "http://h/p1", 0, "http://h/a"), (1, "http://h/p1", 1, "http://o/x"),
        (2, "http://h/p2", 0, "http://h/b"), (2, "http://h/p2", 1, "http://o/y"),
        (2, "http://h/p2", 2, "http://h/a"), (3, "http://h/p3", 0, "http://h:99999/z"),
        (3, "http://h/p3", 1, "http://h/p1")], "page_id long, url string, pos int, dst string")
    seen = spark.createDataFrame([("http://h/p1",), ("http://h/p2",), ("http://h/p3",)], "url string")
    rules = spark.createDataFrame([], FR.ROBOTS_SCHEMA)
    got = [r.url for r in sorted(FR.frontier(links, seen, rules).collect(), key=lambda r: r.position)]
    # preferred (same host) newest first, then others oldest first; bad port and seen dropped
    assert got == ["http://h/b", "http://h/a", "http://o/x", "http://o/y"]
    assert [r.url for r in FR.frontier(links, seen, rules, budget=1).collect()] == ["http://h/b"]


def test_link_health(spark):
    urls = spark.createDataFrame([("u200",), ("u301",), ("u404",), ("umissing",)], "url string")
    st = spark.createDataFrame([("u200", 200), ("u301", 301), ("u404", 404)], "url string, status int")
    got = {r.url: (r.status, r.ok, r.description) for r in V.link_health(urls, st).collect()}
    assert got == {"u200": (200, True, "OK"), "u301": (301, False, "Moved Permanently"),
                   "u404": (404, False, "Not Found"), "umissing": (400, False, "Bad Request")}


def test_frontier_content_type_and_listed_hosts(spark):
    links = spark.createDataFrame([
        (1, "http://h/p1", 0, "http://h/a", "text/html; charset=utf-8"),
        (1, "http://h/p1", 1, "http://wanted.org/x", None),
        (1, "http://h/p1", 2, "http://wanted.org/pic", "image/png")],
        "page_id long, url string, pos int, dst string, content_type string")
    seen = spark.createDataFrame([], "url string")
    rules = spark.createDataFrame([], FR.ROBOTS_SCHEMA)
    got = [r.url for r in FR.frontier(links, seen, rules, hosts=(r"wanted\.",)).orderBy("position").collect()]
    assert got == ["http://wanted.org/x", "http://h/a"]
