"""Quality rules judged per host.

Every document gets counts and rule failures of its own; failures are summed
per host (the ``source`` column), each host's failure rate is shrunk towards
the mean of all hosts with a beta prior whose two parameters come from the
hosts themselves (method of moments), and the verdict of the host is joined
back to its documents. A document is kept when its own base rules hold and its
host's shrunk rate stays below ``MAX_RATE``.

Edge cases: a null text has no words (all counts 0, base failed); a null host
is no host: its documents carry only their own verdict; repeated rows are
counted and returned once each; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_rows, stored, texts_of

MIN_WORDS = 50        # fewer words fail
MAX_REPEAT_PCT = 50   # per cent of words in repeated 3-word windows
MAX_SYMBOL_PCT = 50   # symbols per 100 words
MAX_DUP_PCT = 50      # repeated lines per 100 lines with a word
MAX_RATE = 0.5        # shrunk failure rate from which a host is rejected
SALT_ROWS = 1_000_000  # documents of one host that share a join key
HOT_SHARE = 1000  # a host with more than one in so many documents is dealt over several keys

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

COUNTS = ("n_words long, word_chars long, n_symbols long, n_lines long, "
          "n_dup_lines long, n_repeat_words long")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    _, pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)
    _, inv, cnt = np.unique(pair[:-1].astype(np.int64) * len(ids) + a[2:],
                            return_inverse=True, return_counts=True)
    hit = cnt[inv] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def count_text(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly x20, x09-x0D
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(text.count(c) for c in BLANKS),
            sum(text.count(c) for c in SYMBOLS), len(lines), len(lines) - len(set(lines)),
            repeated_words(words))


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source and the counts of every text (one pass, no shuffle)."""
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def counts(part: pa.RecordBatch) -> dict:
        rows = [count_text(t) for t in texts_of(part)]
        return dict(zip(names, zip(*rows), strict=True))

    return map_rows(docs.select("doc_id", "source", "text"), counts, COUNTS)


def with_rules(counts: DataFrame) -> DataFrame:
    """Adds ``base_failed`` (the document's own verdict) and ``failed`` (any
    rule, what the host is judged by)."""
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    more = (100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("n_words")) | (
        100 * F.col("n_dup_lines") > MAX_DUP_PCT * F.col("n_lines"))
    return counts.withColumn("base_failed", base).withColumn("failed", base | more)


def host_verdicts(rules: DataFrame) -> DataFrame:
    """One row per host: documents, failures, shrunk rate, rejected.

    The prior is beta(mean * strength, (1 - mean) * strength); strength comes
    from the variance of the hosts' rates (mean * (1 - mean) / variance - 1),
    at least 1, and is 1,000,000 when all hosts have one rate."""
    hosts = (rules.where(F.col("source").isNotNull()).groupBy("source")
             .agg(F.count(F.lit(1)).alias("host_docs"),
                  F.sum(F.col("failed").cast("long")).alias("host_failures"))
             .withColumn("rate", F.col("host_failures") / F.col("host_docs")))
    prior = hosts.agg(F.avg("rate").alias("m"), F.var_pop("rate").alias("v")).first()
    mean, var = prior.m or 0.0, prior.v or 0.0
    strength = max(1.0, mean * (1 - mean) / var - 1) if var > 1e-12 else 1e6
    shrunk = (F.col("host_failures") + F.lit(mean * strength)) / (
        F.col("host_docs") + F.lit(strength))
    return (hosts.withColumn("host_rate", shrunk)
            .withColumn("host_rejected", F.col("host_rate") >= MAX_RATE).drop("rate"))


def hot_hosts(hosts: DataFrame) -> DataFrame:
    """(source, salts): the hosts with more than a thousandth of all documents,
    or SALT_ROWS, and into how many keys theirs are dealt. Fewer than 1000 rows,
    or one in SALT_ROWS documents."""
    total = hosts.agg(F.sum("host_docs")).first()[0] or 0
    most = min(SALT_ROWS, max(1, total // HOT_SHARE))
    return hosts.where(F.col("host_docs") > most).select(
        "source", F.ceil(F.col("host_docs") / most).cast("int").alias("salts"))


def host_rules(docs: DataFrame) -> DataFrame:
    """Counts, rules, host rate and verdict of every document.

    The counts are written once; the host table is joined back on (host,
    salt), so the documents of a hot host spread over several keys. Only hot
    hosts are repeated, once for each of their salts."""
    rules = stored(with_rules(document_counts(docs)), "host-rules")
    hosts = stored(host_verdicts(rules), "host-verdicts")
    hot = F.broadcast(hot_hosts(hosts))  # bounded, see there
    salts = F.coalesce("salts", F.when(F.col("source").isNull(), HOT_SHARE).otherwise(1))
    salted = (hosts.join(hot, "source", "left")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts"))
    rows = (rules.join(hot, "source", "left")
            .withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"),
                                       salts).cast("int")).drop("salts"))
    joined = rows.join(salted, ["source", "salt"], "left").drop("salt")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected)


def op10_host_rules(docs: DataFrame) -> DataFrame:
    return host_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
