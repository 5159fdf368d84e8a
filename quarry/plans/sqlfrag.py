"""DuckDB SQL fragments that mirror the Spark column builders.

The oracle SQL of ``__spark_entry__.oracle_sql`` is written with these so
both engines read the same patterns and constants. DuckDB's
``regexp_replace`` needs the ``'g'`` option to replace every match (Spark
always does); ``ln`` is the natural logarithm (``log`` is base 10).
"""

from __future__ import annotations

from quarry.functions import html as H
from quarry.functions import text as TX
from quarry.functions import urls as U
from quarry.functions.constants import ASCII_PUNCTUATION, STOP_MIN_LEN, STOP_WORDS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx_all(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(repl)}, 'g')"


def unescape(x: str) -> str:
    ref = f"regexp_extract(p, {lit(H.REFERENCE_RE)}, 1)"
    names = ", ".join(f"{lit(k)}: {v}" for k, v in H.NAMED.items())
    code = (f"CASE WHEN regexp_matches({ref}, '^#[0-9]+$') THEN CAST({ref}[2:] AS BIGINT) "
            f"WHEN regexp_matches({ref}, '^#[xX]') THEN CAST('0x' || {ref}[3:] AS BIGINT) "
            f"ELSE MAP {{{names}}}[{ref}] END")
    char = (f"CASE WHEN ({code}) BETWEEN 1 AND 55295 OR ({code}) BETWEEN 57344 AND 1114111 "
            f"THEN chr(CAST(({code}) AS INTEGER)) ELSE chr(65533) END")
    piece = (f"CASE WHEN {ref} = '' OR ({code}) IS NULL THEN '&' || p "
             f"ELSE ({char}) || p[length({ref}) + 2:] END")
    return (f"(CASE WHEN contains({x}, '&') THEN string_split({x}, '&')[1] || array_to_string("
            f"list_transform(string_split({x}, '&')[2:], lambda p: {piece}), '') ELSE {x} END)")


def strip_ws(x: str) -> str:
    return rx_all(x, H.EDGE_SPACE_RE, "")


def raw_title(html: str) -> str:
    return (f"CASE WHEN regexp_matches({html}, {lit('(?is)<title[^>]*>.*?</title')}) "
            f"THEN {strip_ws(unescape(f'regexp_extract({html}, {lit(H.TITLE_RE)}, 1)'))} END")


def index_title(html: str) -> str:
    return rx_all(f"lower({raw_title(html)})", H.site_suffix_re(), "")


def clean_title(title: str) -> str:
    t = rx_all(strip_ws(f"lower({title})"), H.site_suffix_re(), "")
    t = rx_all(t, H.PIPE_TAIL_RE, "")
    return rx_all(t, H.PAREN_TAIL_RE, "")


def visible_text(html: str) -> str:
    t = rx_all(html, H.SCRIPT_RE, " ")
    t = rx_all(t, H.STYLE_RE, " ")
    t = rx_all(t, H.COMMENT_RE, " ")
    t = rx_all(t, H.TAG_RE, " ")
    t = unescape(t)
    return strip_ws(rx_all(t, H.SPACE_RE, " "))


def anchor_hrefs(html: str) -> str:
    shown = rx_all(rx_all(html, H.COMMENT_RE, ""), H.SCRIPT_RE, "")
    href = rx_all("h", H.EDGE_QUOTE_RE, "")
    return (f"list_transform(list_transform(regexp_extract_all({shown}, {lit(H.ANCHOR_HREF_RE)}, 1), "
            f"lambda h: {href}), lambda h: {unescape('h')})")


def word_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {lit(TX.WORD_RE)})"


def stop_list() -> str:
    return "[" + ", ".join(lit(w) for w in STOP_WORDS) + "]"


def content_tokens(x: str) -> str:
    return (f"list_filter({word_tokens(x)}, lambda t: length(t) >= {STOP_MIN_LEN} "
            f"AND NOT list_contains({stop_list()}, t))")


def punct_tokens(x: str) -> str:
    cleaned = f"lower(translate({x}, {lit(ASCII_PUNCTUATION)}, ''))"
    return f"list_filter(string_split_regex({cleaned}, {lit(TX.WS_SPLIT_RE)}), lambda t: t <> '')"


def resolve(base: str, raw_href: str) -> str:
    """Resolution for every case but dot segments (none in the fixtures)."""
    href = rx_all(raw_href, U.EDGE_CTRL_RE, "")
    origin = f"regexp_extract({base}, {lit(U.ORIGIN_RE)}, 1)"
    scheme = f"regexp_extract({base}, {lit(U.SCHEME_PART_RE)}, 1)"
    nofrag = f"regexp_extract({base}, {lit(U.NO_FRAGMENT_RE)}, 1)"
    noquery = f"regexp_extract({base}, {lit(U.NO_QUERY_RE)}, 1)"
    bdir = f"regexp_extract({base}, {lit(U.BASE_DIR_RE)}, 1)"
    return (f"CASE WHEN {href} IS NULL THEN NULL "
            f"WHEN {raw_href} = '' THEN {base} "
            f"WHEN {href} = '' THEN {nofrag} "
            f"WHEN regexp_matches({href}, {lit(U.SCHEME_RE)}) THEN {href} "
            f"WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {origin} || {href} "
            f"WHEN starts_with({href}, '?') THEN {noquery} || {href} "
            f"WHEN starts_with({href}, '#') THEN {nofrag} || {href} "
            f"WHEN ends_with({bdir}, '/') THEN {bdir} || {href} "
            f"ELSE {origin} || '/' || {href} END")


def netloc(url: str) -> str:
    return f"regexp_extract({url}, {lit(U.NETLOC_RE)}, 1)"


def host(url: str) -> str:
    n = rx_all(netloc(url), r"^.*@", "")
    return f"lower({rx_all(n, r':[^:\]]*$', '')})"


def port_text(url: str) -> str:
    n = rx_all(netloc(url), r"^.*@", "")
    return f"regexp_extract({n}, {lit(U.PORT_RE)}, 1)"


def port(url: str) -> str:
    p = port_text(url)
    return (f"CASE WHEN regexp_matches({p}, '^[0-9]{{1,5}}$') AND TRY_CAST({p} AS INTEGER) <= 65535 "
            f"THEN TRY_CAST({p} AS INTEGER) END")


def port_ok(url: str) -> str:
    p = port_text(url)
    return (f"({p} = '' OR (regexp_matches({p}, '^[0-9]{{1,5}}$') "
            f"AND TRY_CAST({p} AS INTEGER) <= 65535))")
