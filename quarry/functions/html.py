"""HTML column expressions.

All work happens in JVM regular expressions inside whole-stage codegen; no
parser runs in Python. Each pattern is written with inline flags so that the
DuckDB oracle (RE2) reads the same text: see ``quarry.plans.oracle``.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.constants import POPULARITY_FALLBACK, SITE_SUFFIX, WS_RE

# --- fixed values: patterns ---------------------------------------------------
# href of every <a> tag: a double-, single- or un-quoted value, with its quotes.
ANCHOR_HREF_RE = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^"'\s>]*)"""
EDGE_QUOTE_RE = r"""^["']|["']$"""
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title"
SCRIPT_RE = r"(?is)<script\b[^>]*>.*?</script\s*>"
STYLE_RE = r"(?is)<style\b[^>]*>.*?</style\s*>"
COMMENT_RE = r"(?s)<!--.*?-->"
TAG_RE = r"(?s)<[^>]*>"
SPACE_RE = WS_RE + "+"
EDGE_SPACE_RE = f"^{WS_RE}+|{WS_RE}+$"
POPULARITY_RE = (r"""(?is)<span[^>]*class\s*=\s*["']numbers popularity["'][^>]*>"""
                 r".*?<strong[^>]*>(.*?)</strong")
OG_IMAGE_RE = (r"""(?is)<meta\s[^>]*property\s*=\s*["']og:image["'][^>]*"""
               r"""content\s*=\s*["']([^"']*)["']""")
OG_IMAGE_REV_RE = (r"""(?is)<meta\s[^>]*content\s*=\s*["']([^"']*)["'][^>]*"""
                   r"""property\s*=\s*["']og:image["']""")

# A character reference after its "&": decimal, hexadecimal or named.
REFERENCE_RE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

# Code points of the named references (the HTML 4 table, and &apos;).
NAMED = {**html.entities.name2codepoint, "apos": 39}


def site_suffix_re(site: str = SITE_SUFFIX) -> str:
    return r"\s*-\s*" + site.replace(".", r"\.") + r"\s*$"


PIPE_TAIL_RE = r"\s*\|\s*.+$"
PAREN_TAIL_RE = r"\s*\(.+\)\s*$"


def character(code: Column) -> Column:
    """The character of a code point; U+FFFD for one that is none."""
    known = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
    padded = F.lpad(F.hex(code), 8, "0")
    return F.when(known, F.decode(F.unhex(padded), "UTF-32")).otherwise(F.lit("\ufffd"))


def unescape(col: Column) -> Column:
    """Character references decoded, each once ("&amp;lt;" is "&lt;"): the
    pieces after every "&" are looked at on their own. Unknown names stay."""
    named = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def decoded(piece: Column) -> Column:
        ref = F.regexp_extract(piece, REFERENCE_RE, 1)
        digits = F.regexp_extract(ref, "^#([0-9]+)$", 1)
        hexes = F.regexp_extract(ref, "^#[xX]([0-9a-fA-F]+)$", 1)
        code = (F.when(digits != "", digits.cast("long"))
                .when(hexes != "", F.conv(hexes, 16, 10).cast("long"))
                .otherwise(F.try_element_at(named, ref).cast("long")))
        rest = F.substring(piece, F.length(ref) + 2, F.length(piece))
        return F.when((ref == "") | code.isNull(), F.concat(F.lit("&"), piece)).otherwise(
            F.concat(character(code), rest))

    pieces = F.split(col, "&", -1)
    after = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded)
    return F.when(F.contains(col, F.lit("&")),
                  F.concat(F.element_at(pieces, 1), F.array_join(after, ""))).otherwise(col)


def strip_ws(col: Column) -> Column:
    """Trim all white space, Unicode's too (``F.trim`` only removes spaces)."""
    return F.regexp_replace(col, EDGE_SPACE_RE, "")


def anchor_hrefs(html: Column) -> Column:
    """Array of the href values of all anchors, in document order."""
    shown = F.regexp_replace(F.regexp_replace(html, COMMENT_RE, ""), SCRIPT_RE, "")
    return F.transform(F.regexp_extract_all(shown, F.lit(ANCHOR_HREF_RE), 1),
                       lambda h: unescape(F.regexp_replace(h, EDGE_QUOTE_RE, "")))


def visible_text(html: Column) -> Column:
    """T4 / pin P1: text of a page without script, style, comments and tags."""
    t = F.regexp_replace(html, SCRIPT_RE, " ")
    t = F.regexp_replace(t, STYLE_RE, " ")
    t = F.regexp_replace(t, COMMENT_RE, " ")
    t = F.regexp_replace(t, TAG_RE, " ")
    t = unescape(t)
    return strip_ws(F.regexp_replace(t, SPACE_RE, " "))


def raw_title(html: Column) -> Column:
    """Text of <title>, entities decoded, stripped (null when absent)."""
    t = F.regexp_extract(html, TITLE_RE, 1)
    has = html.rlike(r"(?is)<title[^>]*>.*?</title")
    return F.when(has, strip_ws(unescape(t)))


def index_title(html: Column, site: str = SITE_SUFFIX) -> Column:
    """Title as indexed — stripped, lower case, site suffix removed."""
    return F.regexp_replace(F.lower(raw_title(html)), site_suffix_re(site), "")


def clean_title(title: Column, site: str = SITE_SUFFIX) -> Column:
    """Dictionary title — T8, then cut from the first pipe, then cut a
    trailing parenthesis (from the first opening bracket)."""
    t = F.regexp_replace(strip_ws(F.lower(title)), site_suffix_re(site), "")
    t = F.regexp_replace(t, PIPE_TAIL_RE, "")
    return F.regexp_replace(t, PAREN_TAIL_RE, "")


def popularity(html: Column) -> Column:
    """Popularity number, fallback when absent or not a number."""
    raw = strip_ws(F.regexp_extract(html, POPULARITY_RE, 1))
    num = F.substring(raw, 2, 1 << 30).try_cast("int")
    return F.coalesce(num, F.lit(POPULARITY_FALLBACK))


def title_weight(html: Column) -> Column:
    """weight = fallback - popularity (popular pages weigh more)."""
    return F.lit(POPULARITY_FALLBACK) - popularity(html)


def og_image(html: Column) -> Column:
    """Og:image content, attributes in either order; null when absent."""
    a = F.regexp_extract(html, OG_IMAGE_RE, 1)
    b = F.regexp_extract(html, OG_IMAGE_REV_RE, 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))
