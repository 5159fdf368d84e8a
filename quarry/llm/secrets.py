"""Secret scans over a trigram inverted index, in DataFrame functions only.

Every rule is a regular expression. From each one a Boolean query over
trigrams is derived: an OR of ANDs such that every match contains all trigrams
of one of the ANDs. The index is posting lists (trigram, row) of the trigrams
that the queries ask for; each AND intersects its lists, and only the rows
left, the candidates, are verified with the rule itself. A rule whose
expression forces no trigram scans every row.

Texts are indexed in lower case, which suits rules in either case.
Spans are code points, end exclusive.

Edge cases: a null text is empty and has no spans; repeated rows give equal
rows; rows are told apart by (doc_id, hash of the text), a null id included;
an empty table gives an empty result; other columns are ignored by the query
and kept by the redaction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

try:
    from re import _constants as sre
    from re import _parser as sre_parser
except ImportError:  # Python before 3.11
    import sre_constants as sre
    import sre_parse as sre_parser

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_STRINGS = 64  # strings that an exact set may hold before it is given up
MARK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """``pattern`` as Java and Python read it alike. A match counts when group
    ``group`` has ``least`` characters or more."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


# The base rules, then further well-known token shapes. A least
# length stands in the expression of "access" and "hex": a run of such
# characters is matched whole or, too short, holds no match at all. In "assign"
# a match that is too short still uses up its text, so it is dropped later.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", base=False),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", base=False),
)


# --- trigram queries -------------------------------------------------------

def _ascii_lower(s: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def _members(items) -> set[str] | None:
    """Characters of a small character class, lower-cased; None if large."""
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(_ascii_lower(chr(arg)))
        elif op is sre.RANGE and arg[1] - arg[0] < 8:
            out |= {_ascii_lower(chr(c)) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _sequences(parsed) -> list[tuple[str, ...]]:
    """Strings that matches must contain, as alternatives: every match holds
    all strings of one of the lists, each in one piece."""
    done = [((), "")]  # closed strings, open string
    for op, arg in parsed:
        if op is sre.LITERAL:
            done = [(a, b + _ascii_lower(chr(arg))) for a, b in done]
        elif op is sre.IN and (chars := _members(arg)):
            done = [(a, b + c) for a, b in done for c in sorted(chars)]
        elif op is sre.SUBPATTERN:
            done = _joined(done, _alternatives(arg[3]))
        elif op is sre.BRANCH:
            branches = [_alternatives(branch) for branch in arg[1]]
            done = _joined(done, None if None in branches else sum(branches, []))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and tuple(arg[:2]) == (0, 1):
            inner = _alternatives(arg[2])
            done = _joined(done, ["", *inner]) if inner else _closed(done)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            inner = _alternatives(arg[2])
            done = _closed(_joined(done, inner))
        elif op is not sre.AT:
            done = _closed(done)
        if len(done) > MOST_STRINGS:  # ask for less: what is open is let go
            done = list(dict.fromkeys((a, "") for a, _ in done))
    return [a for a, _ in _closed(done)]


def _closed(done):
    """Open strings put to the closed ones, where they hold a trigram."""
    return list(dict.fromkeys((a + (b,) if len(b) > 2 else a, "") for a, b in done))


def _alternatives(parsed) -> list[str] | None:
    """The strings an expression can match, when they are few and fixed."""
    out = [""]
    for op, arg in parsed:
        if op is sre.LITERAL:
            out = [s + _ascii_lower(chr(arg)) for s in out]
        elif op is sre.IN and (chars := _members(arg)):
            out = [s + c for s in out for c in sorted(chars)]
        elif op is sre.SUBPATTERN and (inner := _alternatives(arg[3])):
            out = [s + t for s in out for t in inner]
        elif op is sre.BRANCH:
            inner = [_alternatives(b) for b in arg[1]]
            if None in inner:
                return None
            out = [s + t for s in out for b in inner for t in b]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and tuple(arg[:2]) == (0, 1):
            inner = _alternatives(arg[2])
            if inner is None:
                return None
            out = [s + t for s in out for t in ["", *inner]]
        else:
            return None
        if len(out) > MOST_STRINGS:
            return None
    return out


def _joined(done, strings):
    if not strings:
        return _closed(done)
    return [(a, b + s) for a, b in done for s in strings]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The OR of ANDs of trigrams that every match's lower-cased text meets;
    empty where some match need not hold any trigram."""
    found = []
    for strings in _sequences(sre_parser.parse(pattern)):
        grams = frozenset(s[i:i + 3] for s in strings for i in range(len(s) - 2))
        if not grams:
            return []
        found.append(grams)
    least = {q for q in found if not any(p < q for p in found)}
    return sorted(least, key=sorted)


# --- index -----------------------------------------------------------------

def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and whole text (null: empty) with the hash that tells rows of
    one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("text", text).withColumn("_h", F.xxhash64("text"))


def postings(rows: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, doc_id, _h): a posting per row and trigram of ``grams`` in it."""
    low = rows.select("doc_id", "_h", F.lower("text").alias("low"))
    held = F.filter(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]),
                    lambda g: g.isNotNull())
    return low.select("doc_id", "_h", F.explode(held).alias("gram"))


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, _h, kinds): the rules whose query a row's postings satisfy.
    One grouping by row intersects all lists: an AND holds when its trigrams
    are all among the row's postings."""
    asked = {r.kind: trigram_query(r.pattern) for r in rules}
    grams = sorted({g for q in asked.values() for a in q for g in a})
    if not grams:
        return rows.select("doc_id", "_h", F.array().cast("array<string>").alias("kinds")).limit(0)
    lists = postings(rows, grams).groupBy("doc_id", "_h").agg(F.collect_set("gram").alias("grams"))

    def holds(query: list[frozenset[str]]) -> Column:
        return reduce(Column.__or__, (
            F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in sorted(a)]))) == len(a)
            for a in query))

    kinds = F.filter(F.array(*[F.when(holds(q), F.lit(k)) for k, q in asked.items() if q]),
                     lambda k: k.isNotNull())
    return lists.select("doc_id", "_h", kinds.alias("kinds")).where(F.size("kinds") > 0)


# --- verification ----------------------------------------------------------

def spans(text: Column, rule: Rule) -> Column:
    """Matches of one rule, leftmost and not overlapping, as structs (start,
    end, kind); those too short are dropped afterwards. Starts follow from the
    lengths of the text between the matches."""
    between = F.split(text, rule.pattern, -1)  # one more than there are matches
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    sizes = F.zip_with(whole, part, lambda w, g: F.struct(F.length(w).alias("size"),
                                                          F.length(g).alias("part")))
    matches = F.zip_with(F.slice(between, F.lit(1), F.size(between) - 1), sizes,
                         lambda t, m: F.struct(F.length(t).alias("gap"), m["size"].alias("size"),
                                               m["part"].alias("part")))
    first = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int,part:int>>").alias("found"))
    walked = F.aggregate(matches, first, lambda s, m: F.struct(
        (s["at"] + m["gap"] + m["size"]).alias("at"),
        F.concat(s["found"], F.array(F.struct(
            (s["at"] + m["gap"]).alias("start"), (s["at"] + m["gap"] + m["size"]).alias("end"),
            m["part"].alias("part")))).alias("found")), lambda s: s["found"])
    return F.transform(F.filter(walked, lambda m: m["part"] >= rule.least), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit(rule.kind).alias("kind")))


NONE = "array<struct<start:int,end:int,kind:string>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` with ``found``: the spans of all rules, an
    array per rule in the order of ``rules``."""
    rows = keyed(docs)
    hits = candidates(rows.select("doc_id", "text", "_h"), rules).withColumnsRenamed(
        {"doc_id": "_id", "_h": "_hh"})
    joined = rows.join(hits.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id"))
                       & (F.col("_h") == F.col("_hh")), "left")

    def verified(rule: Rule) -> Column:
        if trigram_query(rule.pattern):
            wanted = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:  # no trigram to go by: every row
            wanted = F.col("text").rlike(rule.pattern)
        return F.when(wanted, spans(F.col("text"), rule)).otherwise(F.array().cast(NONE))

    return joined.withColumn("found", F.array(*[verified(r) for r in rules])).drop(
        "_id", "_hh", "_h", "kinds")


def in_order(found: list[Column], kinds: list[str]) -> Column:
    """The spans of some rules by start, then by kind as listed."""
    place = F.create_map(*[F.lit(x) for k, kind in enumerate(kinds) for x in (kind, k)])
    return F.sort_array(F.transform(F.concat(*found), lambda m: F.struct(
        m["start"].alias("start"), place[m["kind"]].alias("place"), m["end"].alias("end"),
        m["kind"].alias("kind"))))


def digest(found: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda m: F.concat_ws(
        ":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def op5_secret_scan(docs: DataFrame) -> DataFrame:
    base = [k for k, r in enumerate(RULES) if r.base]
    found = [F.col("found")[k] for k in range(len(RULES))]
    kinds = [r.kind for r in RULES]
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", *[F.size(found[k]).cast("long").alias(f"n_{kinds[k]}") for k in base],
        F.sha2(digest(in_order([found[k] for k in base], kinds)), 256).alias("base_sha256"),
        digest(in_order(found, kinds)).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """Pipeline stage: every span replaced by MARK (overlapping spans by one),
    ``n_chars`` counted anew where there is such a column."""
    columns, kind = docs.columns, dict(docs.dtypes).get("n_chars")
    own = {c: f"_own_{c}" for c in columns if c in ("found", "kinds") or c[0] == "_"}
    docs = docs.withColumnsRenamed(own)  # clashing names stand aside
    found = in_order([F.col("found")[k] for k in range(len(RULES))], [r.kind for r in RULES])
    rows = scan(docs.withColumn("_null", F.col("text").isNull())).withColumn("_all", found)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    parts = F.aggregate("_all", start, lambda s, m: F.struct(
        F.greatest(s["at"], m["end"]).alias("at"),
        F.when(m["start"] >= s["at"], F.concat(s["parts"], F.array(
            F.substring("text", s["at"] + 1, m["start"] - s["at"]), F.lit(MARK))))
        .otherwise(s["parts"]).alias("parts")),
        lambda s: F.concat(s["parts"], F.array(F.substring("text", s["at"] + 1, F.length("text")))))
    changed = F.size("_all") > 0
    rows = rows.withColumn("text", F.when(changed, F.array_join(parts, ""))
                           .when(~F.col("_null"), F.col("text")))
    if kind:
        rows = rows.withColumn("n_chars", F.when(changed, F.length("text").cast(kind))
                               .otherwise(F.col("n_chars")))
    return rows.select(*docs.columns).withColumnsRenamed({v: k for k, v in own.items()})
