"""Text analysis column expressions (T13-T15, pin P2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.constants import ASCII_PUNCTUATION, STOP_MIN_LEN, STOP_WORDS, WS_RE

# --- fixed values: patterns ---------------------------------------------------
# Index token (pin P2): letters, digits, underscore, with single inner dots.
WORD_RE = r"[\p{L}\p{N}_]+(?:\.?[\p{L}\p{N}_]+)*"
# White space for splitting word-vector text.
WS_SPLIT_RE = WS_RE + "+"


def punct_tokens(text: Column) -> Column:
    """Delete ASCII punctuation, lower case, split on whitespace."""
    cleaned = F.lower(F.translate(text, ASCII_PUNCTUATION, ""))
    return F.filter(F.split(cleaned, WS_SPLIT_RE), lambda t: t != "")


def word_tokens(text: Column) -> Column:
    """The title field's analyzer — word tokens of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_RE), 0)


def content_tokens(text: Column) -> Column:
    """T15 without stemming: word tokens minus stop words and 1-letter terms.

    ``filter`` keeps repeats, so term frequencies stay right (``array_except``
    would drop them).
    """
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.filter(word_tokens(text),
                    lambda t: (F.length(t) >= STOP_MIN_LEN) & ~F.array_contains(stop, t))
