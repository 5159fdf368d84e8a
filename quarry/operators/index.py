"""Two-field inverted index.

``build_index(pages)`` writes the postings once (to the shared folder) and
returns DataFrames on them:

* ``docs(url, title, image_url, page_id)`` — stored fields, a row per URL
* ``postings(field, term, url, tf, len)`` — one row per (field, term, doc);
  the document's field length rides along so scoring needs no extra join
* ``doc_freq(field, term, df)``
* ``field_stats(field, n_docs, total_len, avg_len)``

Tokenising is a generator (``explode``) per page inside one stage; the
only shuffle is the (field, term, url) aggregation, which combines map-side.
``quarry.operators.stored_index`` keeps an index in a folder, in segments.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import text as TX
from quarry.functions.porter import with_stems
from quarry.session import scratch_path


@dataclass
class Index:
    docs: DataFrame
    postings: DataFrame
    doc_freq: DataFrame
    field_stats: DataFrame


def page_fields(pages: DataFrame) -> DataFrame:
    """(url, title, content, image_url, page_id) of every page: T8 title, P1
    visible text, T12 image; with ``_copies`` where ``pages`` has it, a null
    ``page_id`` where it has none."""
    extra = [F.col("page_id") if "page_id" in pages.columns else F.lit(None).cast("long").alias("page_id")]
    extra += ["_copies"] if "_copies" in pages.columns else []
    return pages.select(
        "url",
        F.coalesce(H.index_title(F.col("html")), F.lit("")).alias("title"),
        H.visible_text(F.col("html")).alias("content"),
        H.og_image(F.col("html")).alias("image_url"), *extra,
    )


def once(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the column ``name`` worked out once a row: as a generator's
    output it stays a column, where an expression would be put into every later
    one that reads it (and into the filter that a generator brings)."""
    return rows.withColumn(name, F.explode(F.array(name)))


def field_terms(fields: DataFrame,
                which: tuple[str, ...] = ("title", "content")) -> DataFrame:
    """(field, url, term, len, _copies) — one row per token occurrence.

    The title uses the simple analyzer; the content the analyzer with stop
    words and a minimum length (its stems come later, by distinct term).
    """
    if "_copies" not in fields.columns:
        fields = fields.withColumn("_copies", F.lit(1))
    parts = []
    for field, tokens in (("title", TX.word_tokens), ("content", TX.content_tokens)):
        if field in which:
            texts = once(fields.select("url", "_copies", F.col(field).alias("text")), "text")
            t = once(texts.select("url", "_copies", tokens(F.col("text")).alias("toks")), "toks")
            parts.append(t.select(F.lit(field).alias("field"), "url", "_copies",
                                  F.size("toks").alias("len"), F.explode("toks").alias("term")))
    out = parts[0]
    for extra in parts[1:]:
        out = out.unionByName(extra)
    return out


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: like a checkpoint, but columns
    of repeated terms and URLs take little space there."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_per_url(pages: DataFrame) -> DataFrame:
    """The row of the lowest ``page_id`` of every URL (a null id comes last;
    ties go to the smallest hash of the page). A row that is stored several
    times stays so, with their number in ``_copies``.

    Ids, hashes and counts are shuffled. The URLs with several rows are written
    as a table, whose size decides how the pages meet it: where they are few,
    it is broadcast and no page moves."""
    has_id = "page_id" in pages.columns
    pid = F.coalesce("page_id", F.lit(2 ** 63 - 1)) if has_id else F.lit(0)
    rows = (pages.where(F.col("url").isNotNull())
            .withColumn("_pid", pid).withColumn("_h", F.xxhash64("html")))
    several = (rows.groupBy("url", "_pid", "_h").agg(F.count(F.lit(1)).alias("_copies"))
               .groupBy("url").agg(F.min(F.struct("_pid", "_h", "_copies")).alias("_f"),
                                   F.sum("_copies").alias("_rows"))
               .where(F.col("_rows") > 1).select("url", "_f"))
    found = rows.join(_written(several, "several"), "url", "left")
    return (found.where(F.col("_f").isNull() | ((F.col("_f._pid") == F.col("_pid"))
                                                & (F.col("_f._h") == F.col("_h"))))
            .withColumn("_copies", F.coalesce(F.col("_f._copies"), F.lit(1))).drop("_pid", "_h", "_f"))


def build_index(pages: DataFrame, stem: bool = True,
                which: tuple[str, ...] = ("title", "content")) -> Index:
    """Index of ``pages``; ``which`` limits the fields built (a title-only
    search never tokenises page text). A URL stored twice counts once, with
    the row of the lowest ``page_id``."""
    fields = page_fields(one_per_url(pages))
    occ = field_terms(fields, which=which)
    # postings are read by every later step (frequencies, statistics,
    # candidates, verification): computed once and written to the shared
    # folder, as an index build writes its postings anyway
    times = F.count(F.lit(1)) / F.first("_copies")
    postings = _written(occ.groupBy("field", "term", "url")
                        .agg(times.cast("long").alias("tf"), F.first("len").alias("len")), "postings")
    if stem and "content" in which:
        postings = _written(stemmed(postings), "postings")
    doc_freq = postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    stats = _stats_from_postings(postings, pages, which)
    docs = fields.select("url", "title", "image_url", "page_id").distinct()
    return Index(docs=docs, postings=postings, doc_freq=doc_freq, field_stats=stats)


def stemmed(postings: DataFrame) -> DataFrame:
    """Postings of the content field by stem: distinct terms are stemmed once
    and joined back, postings of one stem summed."""
    content = with_stems(postings.where(F.col("field") == "content"))
    content = (content.groupBy("field", "term", "url")
               .agg(F.sum("tf").alias("tf"), F.first("len").alias("len")))
    return postings.where(F.col("field") != "content").unionByName(content)


def _stats_from_postings(postings: DataFrame, pages: DataFrame,
                         which: tuple[str, ...]) -> DataFrame:
    """A9/A10 from the postings: total analysed length per field (the sum of
    the term frequencies) and the document count (every URL, also those whose
    field is empty). One row per field."""
    lens = postings.groupBy("field").agg(F.sum("tf").alias("total_len"))
    docs = (pages.select("url").distinct().agg(F.count(F.lit(1)).alias("n_docs"))
            .select(F.explode(F.array(*[F.lit(f) for f in which])).alias("field"), "n_docs"))
    return with_average(docs.join(lens, "field", "left"))


def with_average(stats: DataFrame) -> DataFrame:
    """``field_stats`` of rows (field, n_docs, total_len or null)."""
    total = F.coalesce(F.col("total_len"), F.lit(0)).cast("long")
    return stats.select("field", "n_docs", total.alias("total_len"),
                        (total / F.col("n_docs")).alias("avg_len"))


def write_index(index: Index, path: str, buckets: int = 64, table: str = "quarry_postings") -> None:
    """The tables of an index as files: postings, as ``table``, partitioned by
    field (partition pruning) and bucketed + sorted by term, one file per
    bucket. ``quarry.operators.stored_index`` keeps an index that grows."""
    (index.postings.repartition(buckets, "term").write.mode("overwrite").partitionBy("field")
     .bucketBy(buckets, "term").sortBy("term")
     .option("path", f"{path}/postings").saveAsTable(table))
    index.doc_freq.write.mode("overwrite").parquet(f"{path}/doc_freq")
    index.field_stats.write.mode("overwrite").parquet(f"{path}/field_stats")
    index.docs.write.mode("overwrite").parquet(f"{path}/docs")
