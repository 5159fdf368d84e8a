"""The registered queries of this package and their SQL.

Each query applies one operator, with its production parameters, to the whole
of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (bpe, collocations, fingerprint, host_rules, html_extract, jaccard, lm_score, packing,
                        quality_crf, retrieval_packing, secrets, toxicity, whitening)
from quarry.llm.common import table


def _on_documents(op: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: op(table(spark, sf_dir, "documents"))


def _on_labelled(op: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda spark, sf_dir: op(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_score": _on_documents(lm_score.op1_lm_score),
        "op2_toxicity": _on_labelled(toxicity.op2_toxicity),
        "op3_packing": _on_documents(packing.op3_packing),
        "op4_byte_bpe": _on_documents(bpe.op4_byte_bpe),
        "op5_secret_scan": _on_documents(secrets.op5_secret_scan),
        "op6_html_extraction": lambda spark, sf_dir: html_extract.op6_html_extraction(
            table(spark, sf_dir, "pages")),
        "op7_ngram_jaccard": _on_documents(jaccard.op7_ngram_jaccard),
        "op8_quality_crf": _on_labelled(quality_crf.op8_quality_crf),
        "op9_fingerprint": _on_documents(fingerprint.op9_fingerprint),
        "op10_host_rules": _on_documents(host_rules.op10_host_rules),
        "op11_retrieval_packing": _on_documents(retrieval_packing.op11_retrieval_packing),
        "op12_collocations": _on_documents(collocations.op12_collocations),
        "op13_whitening": lambda spark, sf_dir: whitening.op13_whitening(
            table(spark, sf_dir, "embeddings")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_secret_scan": OP5_SQL, "op10_host_rules": OP10_SQL, "op12_collocations": OP12_SQL}


#: Words are runs of bytes other than blanks; windows of three words.
OP10_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
win AS (
  SELECT rid, i, words[i] || chr(32) || words[i + 1] || chr(32) || words[i + 2] AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
hit AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM hit, (VALUES (0), (1), (2)) AS s(k)
  GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
c AS (
  SELECT w.rid, doc_id, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines USING (rid) LEFT JOIN cov USING (rid)),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    100 * n_symbols > 50 * n_words OR 100 * n_dup_lines > 50 * n_lines AS more_failed FROM c),
h AS (
  SELECT source, count(*) AS n, sum((base_failed OR more_failed)::INT) AS f
  FROM r WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 1e-12 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 1e6 END AS k FROM p),
bad AS (SELECT source FROM h, s WHERE (f + m * k) / (n + k) >= 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM r
"""


def _span_sql() -> str:
    """Spans of every rule by plain scanning: lengths of the text between the
    matches and of the matches give the starts."""
    parts = []
    for k, r in enumerate(secrets.RULES):
        pat = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT rid, {k} AS place, '{r.kind}' AS kind, {str(r.base).lower()} AS base,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) +
      coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s, length(hits[i]) AS n
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT rid, regexp_split_to_array(text, '{pat}') AS gaps,
      regexp_extract_all(text, '{pat}', 0) AS hits,
      regexp_extract_all(text, '{pat}', {r.group}) AS own
    FROM t WHERE regexp_matches(text, '{pat}')))
  WHERE length(own[i]) >= {r.least}""")
    return " UNION ALL ".join(parts)


OP5_SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_span_sql()}),
g AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign,
    count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, place)
      FILTER (base), '') AS own,
    string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, place) AS spans
  FROM m GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(own, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (rid)
"""


#: Phrases counted as joined strings over every piece; products as HUGEINT.
OP12_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
g AS (
  SELECT lang, m, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS phrase FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM p, (VALUES (1), (2), (3)) AS s(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
k AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, x.f AS l, y.f AS r, 1000000 * c.a * c.a // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') AND x.m = k
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ') AND y.m = c.m - k),
low AS (
  SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, m, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase FROM c, (VALUES (1), (2)) AS s(i) WHERE m = 3)
  GROUP BY ALL),
r AS (
  SELECT low.lang, low.phrase, a, l, r, score,
    row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank
  FROM low LEFT JOIN longer ON longer.lang = low.lang AND longer.phrase = low.phrase AND low.m = 2
  WHERE most IS NULL OR 100 * most < 50 * a)
SELECT r.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  n::BIGINT AS n, score::BIGINT AS score
FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
