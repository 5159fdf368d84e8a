"""File sources and sinks.

* ``read_html_dir`` — one document per file (``wholetext``) joined to a URL
  map, for corpora kept as a folder of saved pages.
* ``read_adjacency_csv`` — the documented dense matrix format (header of
  URLs after an empty first cell, one row per URL) to an edge list: cells meet
  the header by their place, so the plan does not grow with the columns.
* ``read_sitemaps`` / ``write_sitemaps`` — seed lists as sitemap files (XML).
* sinks — edges, ranks, title dictionary (JSON with explicit schema),
  synonyms, images — all written by Spark in parallel; readers use explicit
  schemas (no inference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EDGES_SCHEMA = "src string, dst string, n long"
RANKS_SCHEMA = "url string, pr double"
TITLES_SCHEMA = "title string, weight int"
SYNONYMS_SCHEMA = "title string, seq int, synonym string"
IMAGES_SCHEMA = "url string, image_url string"


def read_html_dir(spark: SparkSession, folder: str, url_map: DataFrame) -> DataFrame:
    """``folder`` of saved pages + ``url_map(url, doc_id)`` (doc_id = file
    name) → ``(url, doc_id, html)``."""
    files = (spark.read.text(folder, wholetext=True)
             .select(F.col("_metadata.file_name").alias("doc_id"),
                     F.col("value").alias("html")))
    return url_map.select("url", "doc_id").join(files, "doc_id").select("url", "doc_id", "html")


def read_adjacency_csv(spark: SparkSession, path: str) -> DataFrame:
    """Dense adjacency CSV → ``(src, dst, w)`` for cells > 0. The header is
    the line whose first cell is empty; cells may be quoted."""
    cell = r'\s*("[^"]*"|[^,]*?)\s*(?:,|$)'  # one after the other, commas within quotes kept
    line = F.col("value")
    cells = (F.when(line.contains('"'), F.regexp_extract_all(line, F.lit(cell), 1))
             .otherwise(F.split(line, ",")))
    clean = F.transform(cells, lambda c: F.regexp_replace(F.trim(F.translate(c, "\t", " ")), r'^"|"$', ""))
    rows = (spark.read.text(path).where(F.trim(line) != "").select(clean.alias("cells"))
            .select(F.col("cells")[0].alias("src"), F.posexplode("cells").alias("pos", "cell"))
            .where("pos > 0"))
    header = rows.where(F.col("src") == "").select("pos", F.col("cell").alias("dst"))
    body = (rows.where(F.col("src") != "")
            .select("src", "pos", F.col("cell").try_cast("double").alias("w")).where(F.col("w") > 0))
    return body.join(header, "pos").select("src", "dst", "w")


def write_sitemaps(seeds: DataFrame, path: str) -> None:
    """Seed lists ``(domain, seq, url)`` as sitemaps, one ``urlset`` per
    domain (a sitemap holds 50,000 URLs at most, by its standard)."""
    urls = F.transform(F.array_sort(F.collect_list(F.struct("seq", "url"))),
                       lambda x: F.struct(x["url"].alias("loc")))
    (seeds.groupBy("domain").agg(urls.alias("url")).select("url")
     .write.mode("overwrite").format("xml").option("rootTag", "sitemaps").option("rowTag", "urlset").save(path))


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap files → ``(domain, seq, url)`` in the files' order; the
    domain is the host of a list's first URL. Entries without an address are
    left out."""
    from quarry.functions import urls as U
    lists = (spark.read.format("xml").option("rowTag", "urlset")
             .schema("url array<struct<loc:string>>").load(path))
    loc = F.filter(F.transform("url", lambda u: F.trim(u["loc"])), lambda u: u != "")
    return (lists.select(loc.alias("urls")).where(F.size("urls") > 0)
            .select(U.host(F.col("urls")[0]).alias("domain"), F.posexplode("urls").alias("seq", "url")))


def write_edges(edges: DataFrame, path: str, buckets: int | None = None,
                table: str = "quarry_edges") -> None:
    """Edge list as parquet; with ``buckets`` as the bucketed ``table``
    sorted by ``src``, one file per bucket, so PageRank's join on ``src`` reads
    co-partitioned data."""
    if buckets:
        (edges.repartition(buckets, "src").write.mode("overwrite").bucketBy(buckets, "src").sortBy("src")
         .option("path", path).saveAsTable(table))
    else:
        edges.write.mode("overwrite").parquet(path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EDGES_SCHEMA).parquet(path)


def write_ranks(ranks: DataFrame, path: str) -> None:
    """PageRank table."""
    ranks.select("url", "pr").write.mode("overwrite").parquet(path)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RANKS_SCHEMA).parquet(path)


def write_titles(titles: DataFrame, path: str) -> None:
    """Title dictionary as JSON lines."""
    titles.select("title", F.col("weight").cast("int")).write.mode("overwrite").json(path)


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TITLES_SCHEMA).json(path)


def write_synonyms(synonyms: DataFrame, path: str) -> None:
    """Synonym rows; ``read_synonym_lists`` gives the list form."""
    synonyms.select("title", "seq", "synonym").write.mode("overwrite").parquet(path)


def read_synonyms(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SYNONYMS_SCHEMA).parquet(path)


def read_synonym_lists(spark: SparkSession, path: str) -> DataFrame:
    """``(title, synonyms ARRAY<STRING>)`` in ``seq`` order (one title's list)."""
    s = read_synonyms(spark, path)
    return (s.groupBy("title")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "synonym"))),
                             lambda x: x["synonym"]).alias("synonyms")))


def write_images(images: DataFrame, path: str) -> None:
    """Page image table."""
    images.select("url", "image_url").write.mode("overwrite").parquet(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IMAGES_SCHEMA).parquet(path)
