"""The crawl loop as tables that grow batch by batch.

``ingest_tables`` runs ``foreachBatch`` over page files. Every batch writes its
own part of each table below ``base``, so that a batch that is run again after
a failure writes the same part anew:

* ``pages`` (page_id, url, html) and ``clean`` (url, text): new pages, raw and
  as text, each URL once;
* ``seen`` (url): their URLs; a batch leaves out what earlier batches saw;
* ``edges`` (src, dst): their distinct out-links;
* ``bad`` (page_id, url, html, reason): rows without a usable URL or page;
* ``counters`` (rows, bad_rows, new_pages, links, ...): one row per batch, from
  Spark's observed metrics.

Within a batch the lowest ``page_id`` of a URL stays (a null id last). Readers
use ``read_table``; files of a batch appear when its part is complete.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import urls as U
from quarry.streaming.ingest import PAGES_SCHEMA

TABLES = {
    "pages": "page_id long, url string, html string",
    "clean": "url string, text string",
    "seen": "url string",
    "edges": "src string, dst string",
    "bad": "page_id long, url string, html string, reason string",
    "counters": "rows long, bad_rows long, new_pages long, links long, text_chars long",
}


def read_table(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """One of TABLES with its ``batch`` column; empty before the first batch."""
    from quarry.session import path_exists
    path = os.path.join(base, kind)
    schema = f"{TABLES[kind]}, batch long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _put(df: DataFrame, base: str, kind: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(os.path.join(base, kind, f"batch={batch}"))


def _reason():
    host = U.host(F.col("url"))
    return (F.when(F.col("url").isNull() | (F.trim("url") == ""), "no url")
            .when(F.coalesce(host, F.lit("")) == "", "no host")
            .when(F.col("html").isNull(), "no page"))


def write_batch(rows: DataFrame, batch: int, base: str) -> None:
    """All parts of one batch; run again it gives the same."""
    spark = rows.sparkSession
    checked = rows.select("page_id", "url", "html", _reason().alias("reason"))
    _put(checked.where(F.col("reason").isNotNull()), base, "bad", batch)
    good = checked.where(F.col("reason").isNull())
    before = read_table(spark, base, "seen").where(F.col("batch") < batch).select("url")
    # ids and hashes choose the row of a URL; pages are joined to them afterwards
    order = F.struct(F.coalesce("page_id", F.lit(2 ** 63 - 1)).alias("p"), F.xxhash64("html").alias("h"))
    first = good.groupBy("url").agg(F.min(order).alias("f")).join(before, "url", "left_anti")
    _put(first.select("url"), base, "seen", batch)
    chosen = spark.read.schema("url string").parquet(os.path.join(base, "seen", f"batch={batch}"))
    keep = first.join(chosen, "url", "left_semi")
    marked = good.withColumn("f", order)
    new = marked.join(keep, ["url", "f"], "left_semi").select("page_id", "url", "html").dropDuplicates(["url"])
    _put(new, base, "pages", batch)
    stored = spark.read.schema(TABLES["pages"]).parquet(os.path.join(base, "pages", f"batch={batch}"))
    texts, links, all_rows = Observation(), Observation(), Observation()
    text = stored.select("url", H.visible_text(F.col("html")).alias("text"))
    _put(text.observe(texts, F.count(F.lit(1)).alias("new_pages"),
                      F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("text_chars")), base, "clean", batch)
    hrefs = F.filter(H.anchor_hrefs(F.col("html")), lambda h: h != "")
    dsts = F.array_distinct(F.transform(hrefs, lambda h: U.resolve(F.col("url"), h)))
    edges = stored.select(F.col("url").alias("src"), F.explode(dsts).alias("dst"))
    _put(edges.observe(links, F.count(F.lit(1)).alias("links")), base, "edges", batch)
    # the counts of the whole input pass by without a table of their own
    checked.select("reason").observe(
        all_rows, F.count(F.lit(1)).alias("rows"), F.count("reason").alias("bad_rows")) \
        .write.format("noop").mode("overwrite").save()
    got = all_rows.get | texts.get | links.get
    names = [c.split()[0] for c in TABLES["counters"].split(", ")]
    _put(spark.createDataFrame([tuple(got[n] for n in names)], TABLES["counters"]), base, "counters", batch)


def ingest_tables(spark: SparkSession, source: str, base: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, glob: str | None = None):
    """Ingest everything now in folder ``source`` (files matching ``glob``) and
    stop; call again for what has arrived since."""
    reader = spark.readStream.schema(PAGES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    query = (reader.parquet(source).writeStream
             .foreachBatch(lambda rows, batch: write_batch(rows, batch, base))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
