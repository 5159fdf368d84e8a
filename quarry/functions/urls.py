"""URL column expressions.

Resolution of a link against its page follows RFC 3986 as Python's
``urllib.parse.urljoin`` does, entirely in JVM expressions: string
functions for absolute, network-path, root-relative, query-only,
fragment-only and plain relative links, and array higher-order functions
for the (rare) paths with ``.``/``..`` segments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns ---------------------------------------------------
SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
NETLOC_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
ORIGIN_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
SCHEME_PART_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
NO_FRAGMENT_RE = r"^([^#]*)"
NO_QUERY_RE = r"^([^?#]*)"
# Directory of the base: everything up to the last slash of the path part.
BASE_DIR_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(?:[^?#]*/)?)"
DOT_SEGMENT_RE = r"(^|/)\.\.?(/|$|\?|#)"
BASE_PATH_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"
PORT_RE = r":([^:\]]*)$"
EDGE_CTRL_RE = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _remove_dots(base: Column, href: Column) -> Column:
    """Merge a relative path with the base path and remove ``.``/``..``
    segments (RFC 3986 §5.2, as ``urljoin`` does), with array
    higher-order functions — no Python.

    ``urljoin`` specifics kept: a non-root path joins the base directory and
    drops empty inner segments; ``..`` above the root is ignored; a trailing
    ``.``/``..`` leaves a trailing slash.
    """
    bpath = F.regexp_extract(base, BASE_PATH_RE, 1)
    hpath = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    bparts = F.split(bpath, "/")
    bdir = F.when(F.element_at(bparts, -1) != "",
                  F.slice(bparts, 1, F.greatest(F.size(bparts) - 1, F.lit(0)))) \
        .otherwise(bparts)
    hparts = F.split(hpath, "/")
    merged = F.concat(bdir, hparts)
    merged = F.filter(merged, lambda x, i: (i == 0) | (i == F.size(merged) - 1) | (x != ""))
    segs = F.when(hpath.startswith("/"), hparts).otherwise(merged)
    out = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x))))
    out = F.when(F.element_at(segs, -1).isin(".", ".."), F.concat(out, F.array(F.lit("")))) \
        .otherwise(out)
    path = F.array_join(out, "/")
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.concat(F.regexp_extract(base, ORIGIN_RE, 1), path, tail)


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` found on page ``base``.

    Leading/trailing control characters and spaces of the href are ignored,
    as the URL parser does."""
    raw = href
    href = F.regexp_replace(href, EDGE_CTRL_RE, "")
    # "//" with an empty authority is a path reference ("///a" is "/a")
    href = F.when(href.startswith("//") & ~href.rlike(r"^//[^/?#]"),
                  F.substring(href, 3, 1 << 30)).otherwise(href)
    origin = F.regexp_extract(base, ORIGIN_RE, 1)
    scheme = F.regexp_extract(base, SCHEME_PART_RE, 1)
    base_nofrag = F.regexp_extract(base, NO_FRAGMENT_RE, 1)
    base_noquery = F.regexp_extract(base, NO_QUERY_RE, 1)
    base_dir = F.regexp_extract(base, BASE_DIR_RE, 1)
    relative = (~href.rlike(SCHEME_RE)) & (~href.startswith("//"))
    hpath = F.regexp_extract(href, r"^([^?#]*)", 1)
    bpath = F.regexp_extract(base, BASE_PATH_RE, 1)
    path_ref = relative & (hpath != "")
    merges_base = path_ref & ~hpath.startswith("/")
    # dot segments to remove, or (for a merge with the base path) empty
    # segments to drop, in the href or in the base path it is merged with
    dotted = path_ref & (hpath.rlike(DOT_SEGMENT_RE)
                         | (merges_base & hpath.contains("//"))
                         | (merges_base & (bpath.rlike(DOT_SEGMENT_RE) | bpath.contains("//"))))
    base_has_path = base_dir.endswith("/")
    return (
        F.when(href.isNull(), F.lit(None).cast("string"))
        .when(raw == "", base)
        .when(href == "", base_nofrag)
        .when(href.rlike(SCHEME_RE), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(dotted, _remove_dots(base, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(base_noquery, href))
        .when(href.startswith("#"), F.concat(base_nofrag, href))
        .when(base_has_path, F.concat(base_dir, href))
        .otherwise(F.concat(origin, F.lit("/"), href))
    )


def netloc(url: Column) -> Column:
    """``urlparse(url).netloc``: authority part, as written."""
    return F.regexp_extract(url, NETLOC_RE, 1)


def host(url: Column) -> Column:
    """Host name: netloc without user info and port, lower case."""
    n = F.regexp_replace(netloc(url), r"^.*@", "")
    return F.lower(F.regexp_replace(n, r":[^:\]]*$", ""))


def port_text(url: Column) -> Column:
    """Text after the last colon of the host part ('' when none)."""
    n = F.regexp_replace(netloc(url), r"^.*@", "")
    return F.regexp_extract(n, PORT_RE, 1)


def port(url: Column) -> Column:
    """Port number; null when absent or not a valid port."""
    p = port_text(url)
    return F.when(p.rlike(r"^[0-9]{1,5}$") & (p.cast("int") <= 65535), p.cast("int"))


def port_ok(url: Column) -> Column:
    """false when a port is written but cannot be used (not a number or
    outside 0-65535)."""
    p = port_text(url)
    return (p == "") | (p.rlike(r"^[0-9]{1,5}$") & (p.cast("int") <= 65535))


def doc_hash(url: Column) -> Column:
    """SHA-256 hex digest of the URL (UTF-8)."""
    return F.sha2(url, 256)
