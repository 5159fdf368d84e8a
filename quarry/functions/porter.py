"""Porter stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980) as
SQL expressions.

The algorithm's conditions on a stem are regular: with ``c`` a consonant, ``v``
a vowel, ``C`` and ``V`` runs of them, a word is ``[C](VC)^m[V]``, so that
"m > 0" or "ends in a consonant" are patterns. ``y`` is a vowel after a
consonant, which the patterns say by where a run ends; a ``y`` at the beginning
is a consonant and stands as ``Y`` meanwhile. Every step is one expression of
the step before; ``with_stems`` applies them to the distinct terms of a table,
and ``stem_sql`` writes the same steps as nested queries for an engine with a
``regexp_matches`` function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

# --- fixed values: suffix rules of the published algorithm --------------------
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
          ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
          ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
          ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
          ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
          ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
          "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")



# runs of consonants and vowels
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
SOME = f"^({_C})?{_V}{_C}"                       # m > 0
MORE = f"^({_C})?{_V}{_C}{_V}{_C}"               # m > 1
ONE = f"^({_C})?{_V}{_C}({_V})?$"                # m = 1
VOWEL = f"^({_C})?[aeiouy]"                      # there is a vowel
CONSONANT = f"^({_C})?({_V}{_C})*$"              # the last letter is a consonant
SHORT = f"^{_C}[aeiouy][^aeiouwxy]$"             # m = 1, ends consonant, vowel, consonant


def _ends(*suffixes: str, of: str = "w") -> str:
    return "(" + " OR ".join(f"right({of}, {len(x)}) = '{x}'" for x in suffixes) + ")"


def _cut(n: int, add: str = "") -> str:
    stem = f"left(w, length(w) - {n})"
    return f"{stem} || '{add}'" if add else stem


def _cases(rules, then) -> str:
    """The longest suffix decides, whether or not its condition holds."""
    branches = [f"WHEN {_ends(x)} THEN {then(x)}" for x in sorted(rules, key=len, reverse=True)]
    return f"CASE {' '.join(branches)} ELSE w END"


def steps(like) -> list[dict[str, str]]:
    """The columns of every step by those of the one before, from ``w``;
    ``like(value, pattern)`` writes a match. The last step's ``w`` is the stem."""
    def doubled(of="w"):
        return (f"(length({of}) > 1 AND right({of}, 1) = left(right({of}, 2), 1) "
                f"AND {like(of, CONSONANT)})")

    def swap(rules):
        to = dict(rules)
        return _cases(to, lambda x: f"CASE WHEN {like(_cut(len(x)), SOME)} "
                                    f"THEN {_cut(len(x), to[x])} ELSE w END")

    gone = " OR ".join(f"({_ends(x)} AND {like(_cut(len(x)), VOWEL)})" for x in ("ed", "ing"))
    last = f"right({_cut(3)}, 1) IN ('s', 't')"
    return [
        {"w": "CASE WHEN left(w, 1) = 'y' THEN 'Y' || substr(w, 2) ELSE w END"},
        {"w": f"CASE WHEN {_ends('sses', 'ies')} THEN {_cut(2)} WHEN {_ends('ss')} THEN w "
              f"WHEN {_ends('s')} THEN {_cut(1)} ELSE w END"},
        {"w": f"CASE WHEN {_ends('eed')} THEN CASE WHEN {like(_cut(3), SOME)} THEN {_cut(1)} ELSE w END "
              f"WHEN {_ends('ed')} AND {like(_cut(2), VOWEL)} THEN {_cut(2)} "
              f"WHEN {_ends('ing')} AND {like(_cut(3), VOWEL)} THEN {_cut(3)} ELSE w END",
         "again": f"NOT {_ends('eed')} AND ({gone})"},
        {"w": f"CASE WHEN NOT again THEN w WHEN {_ends('at', 'bl', 'iz')} THEN w || 'e' "
              f"WHEN {doubled()} AND NOT {_ends('l', 's', 'z')} THEN {_cut(1)} "
              f"WHEN {like('w', SHORT)} THEN w || 'e' ELSE w END"},
        {"w": f"CASE WHEN {_ends('y')} AND {like(_cut(1), VOWEL)} THEN {_cut(1, 'i')} ELSE w END"},
        {"w": swap(STEP2)},
        {"w": swap(STEP3)},
        {"w": _cases(STEP4, lambda x: f"CASE WHEN {like(_cut(len(x)), MORE)}"
                                      f"{' AND ' + last if x == 'ion' else ''} THEN {_cut(len(x))} ELSE w END")},
        {"w": f"CASE WHEN {_ends('e')} AND ({like(_cut(1), MORE)} OR ({like(_cut(1), ONE)} "
              f"AND NOT {like(_cut(1), SHORT)})) THEN {_cut(1)} ELSE w END"},
        {"w": f"CASE WHEN {like('w', MORE)} AND {doubled()} AND {_ends('l')} THEN {_cut(1)} ELSE w END"},
        {"w": "CASE WHEN left(w, 1) = 'Y' THEN 'y' || substr(w, 2) ELSE w END"},
    ]


def _spark_like(value: str, pattern: str) -> str:
    return f"({value} RLIKE '{pattern}')"


def stem_table(terms: DataFrame) -> DataFrame:
    """(term, stem) of every distinct term; terms of one or two letters stay.
    Checkpointed: a filter on the stem must not be pushed down through the
    steps, whose expressions would be written into each other."""
    ensure_checkpoint_dir(terms.sparkSession)
    df = terms.select("term").distinct().withColumn("w", F.col("term"))
    for step in steps(_spark_like):
        df = df.selectExpr("term", *[f"{e} AS {name}" for name, e in step.items()])
    stems = df.selectExpr("term", "CASE WHEN length(term) <= 2 THEN term ELSE w END AS stem")
    return stems.checkpoint(eager=True)


def with_stems(df: DataFrame) -> DataFrame:
    """``df`` with its ``term`` stemmed: distinct terms are stemmed once and
    joined back."""
    return (df.join(stem_table(df), "term")
            .withColumn("term", F.col("stem")).select(*df.columns))


def stem_sql(query: str) -> str:
    """SQL text: the rows of ``query`` with column ``term`` and its ``stem``."""
    inner = f"SELECT DISTINCT term, term AS w FROM ({query})"
    for step in steps(lambda value, pattern: f"regexp_matches({value}, '{pattern}')"):
        inner = f"SELECT term, {', '.join(f'{e} AS {name}' for name, e in step.items())} FROM ({inner})"
    stems = f"SELECT term, CASE WHEN length(term) <= 2 THEN term ELSE w END AS stem FROM ({inner})"
    return f"SELECT q.*, s.stem FROM ({query}) q JOIN ({stems}) s ON q.term = s.term"
