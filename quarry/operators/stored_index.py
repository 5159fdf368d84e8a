"""An index kept in a folder, in segments.

``create_index`` writes a first segment, ``add_pages`` a further one for pages
that arrive later, ``delete_urls`` takes pages out, ``merge_segments`` writes
what is live as one segment again, ``open_index`` gives an ``Index`` to search.
Nothing is rewritten but by a merge.

Below the folder lie Parquet tables, each partitioned by ``segment``:

* ``postings``, ``terms`` (document frequencies), bucketed by (field, term):
  a join or sum by term reads the buckets of all segments with no exchange of
  the stored side;
* ``docs`` (url, title, image_url, page_id), bucketed by url;
* ``stats`` (field, n_docs, total_len), some rows;
* ``dead`` (url, of_segment): what a deletion took out of earlier segments.

A deletion also writes negative rows of ``terms`` and ``stats``, so that merged
statistics are plain sums and equal those of an index built anew. A commit is
one row in ``commits``, written last: segments without a commit, left by a job
that failed, are not read, and the next writer replaces them. There is one
writer at a time.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.index import Index, build_index, with_average
from quarry.session import path_exists, remove_path
from quarry.sources.tables import literal_table

#: Columns and bucket keys of the tables.
TABLES = {
    "postings": ("field STRING, term STRING, url STRING, tf BIGINT, len INT", ("field", "term")),
    "terms": ("field STRING, term STRING, df BIGINT", ("field", "term")),
    "docs": ("url STRING, title STRING, image_url STRING, page_id BIGINT", ("url",)),
    "stats": ("field STRING, n_docs BIGINT, total_len BIGINT", ("field",)),
    "dead": ("url STRING, of_segment INT", ("url",)),
}
COMMITS = "segment INT, kind STRING"
META = "stem BOOLEAN, fields ARRAY<STRING>, buckets INT"


@dataclass
class State:
    """What the commits say: the live segments in order, those among them that
    add and those that delete."""
    last: int
    live: list[int]
    adds: list[int]
    deletes: list[int]


def _state(spark: SparkSession, path: str) -> State:
    rows = sorted((r.segment, r.kind) for r in
                  spark.read.schema(COMMITS).json(os.path.join(path, "commits")).collect())
    merged = max((s for s, k in rows if k == "merge"), default=0)
    live = [(s, k) for s, k in rows if s >= merged]  # a row per commit since the last merge
    return State(max((s for s, _ in rows), default=0), [s for s, _ in live],
                 [s for s, k in live if k != "delete"], [s for s, k in live if k == "delete"])


def _commit(spark: SparkSession, path: str, segment: int, kind: str) -> None:
    (literal_table(spark, [(segment, kind)], COMMITS).coalesce(1)
     .write.mode("append").json(os.path.join(path, "commits")))


def _meta(spark: SparkSession, path: str):
    return spark.read.schema(META).json(os.path.join(path, "meta")).first()


def _name(path: str, kind: str) -> str:
    return f"quarry_index_{hashlib.md5(path.encode()).hexdigest()[:16]}_{kind}"


def _register(spark: SparkSession, path: str, buckets: int) -> None:
    """Name the folder's tables in the session's catalogue."""
    for kind, (columns, keys) in TABLES.items():
        location = os.path.join(path, kind).replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path, kind)} ({columns}, segment INT) USING parquet "
                  f"PARTITIONED BY (segment) CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS "
                  f"LOCATION '{location}'")
        if path_exists(spark, os.path.join(path, kind)):  # segments that others wrote
            spark.sql(f"MSCK REPAIR TABLE {_name(path, kind)}")
        spark.catalog.refreshTable(_name(path, kind))


def _table(spark: SparkSession, path: str, kind: str, segments: list[int]) -> DataFrame:
    return spark.table(_name(path, kind)).where(F.col("segment").isin(segments))


def _write(spark: SparkSession, path: str, kind: str, df: DataFrame, segment: int,
           buckets: int) -> None:
    """One segment of a table, one file per bucket."""
    columns, keys = TABLES[kind]
    remove_path(spark, os.path.join(path, kind, f"segment={segment}"))  # of a failed writer
    names = [c.split()[0] for c in columns.split(", ")]
    (df.select(*names, F.lit(segment).cast("int").alias("segment")).repartition(buckets, *keys)
     .write.mode("append").format("parquet").partitionBy("segment").bucketBy(buckets, *keys)
     .saveAsTable(_name(path, kind)))


def _write_segment(spark: SparkSession, path: str, index: Index, segment: int, buckets: int,
                   kind: str) -> None:
    _write(spark, path, "postings", index.postings, segment, buckets)
    written = spark.table(_name(path, "postings")).where(F.col("segment") == segment)
    terms = written.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    _write(spark, path, "terms", terms, segment, buckets)
    _write(spark, path, "stats", index.field_stats, segment, buckets)
    _write(spark, path, "docs", index.docs, segment, buckets)
    _commit(spark, path, segment, kind)


def create_index(path: str, pages: DataFrame, stem: bool = True,
                 which: tuple[str, ...] = ("title", "content"), buckets: int | None = None) -> None:
    """A new index of ``pages`` in an empty folder. ``buckets`` (the session's
    shuffle partitions) should suit the size the index will have."""
    spark = pages.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([(stem, list(which), buckets)], META).coalesce(1) \
        .write.mode("error").json(os.path.join(path, "meta"))
    _register(spark, path, buckets)
    _write_segment(spark, path, build_index(pages, stem, which), 1, buckets, "add")


def add_pages(path: str, pages: DataFrame) -> int:
    """A segment for the pages whose URL is not in the index yet; gives its
    number. A URL is stored once: the page that came first stays."""
    spark = pages.sparkSession
    meta, state = _meta(spark, path), _state(spark, path)
    _register(spark, path, meta.buckets)
    known = (_live(spark, path, "docs", state).select("url")
             .join(pages.select("url").distinct(), "url", "left_semi"))
    new = pages.join(known, "url", "left_anti")
    _write_segment(spark, path, build_index(new, meta.stem, tuple(meta.fields)), state.last + 1,
                   meta.buckets, "add")
    return state.last + 1


def delete_urls(path: str, urls: DataFrame) -> int:
    """Take the pages of ``urls(url)`` out; gives the number of the segment
    that says so. Unknown URLs are ignored."""
    spark = urls.sparkSession
    meta, state = _meta(spark, path), _state(spark, path)
    _register(spark, path, meta.buckets)
    segment = state.last + 1
    gone = (_live(spark, path, "docs", state).join(urls.select("url").distinct(), "url", "left_semi")
            .select("url", F.col("segment").alias("of_segment")))
    _write(spark, path, "dead", gone, segment, meta.buckets)
    gone = spark.table(_name(path, "dead")).where(F.col("segment") == segment)
    postings = _of(_table(spark, path, "postings", state.adds), gone, "left_semi")
    terms = postings.groupBy("field", "term").agg((-F.count(F.lit(1))).alias("df"))
    _write(spark, path, "terms", terms, segment, meta.buckets)
    count = gone.agg((-F.count(F.lit(1))).alias("n_docs")).select(
        F.explode(F.array(*[F.lit(f) for f in meta.fields])).alias("field"), "n_docs")
    lens = postings.groupBy("field").agg((-F.sum("tf")).alias("total_len"))
    _write(spark, path, "stats", count.join(lens, "field", "left"), segment, meta.buckets)
    _commit(spark, path, segment, "delete")
    return segment


def merge_segments(path: str, spark: SparkSession) -> int:
    """Write all live pages as one segment; earlier ones are not read any more
    (``remove_merged`` deletes their files)."""
    meta, state = _meta(spark, path), _state(spark, path)
    _write_segment(spark, path, open_index(spark, path), state.last + 1, meta.buckets, "merge")
    return state.last + 1


def remove_merged(path: str, spark: SparkSession) -> None:
    """Delete the files of segments before the last merge; for times when
    nobody reads an index opened before it."""
    first = min(_state(spark, path).live, default=0)
    for kind in TABLES:
        for segment in range(1, first):
            remove_path(spark, os.path.join(path, kind, f"segment={segment}"))


def _of(rows: DataFrame, dead: DataFrame, how: str) -> DataFrame:
    """Rows (url, segment, ...) that are, or are not, among the dead."""
    d = dead.select(F.col("url").alias("_u"), F.col("of_segment").alias("_s"))
    return rows.join(d, (F.col("url") == F.col("_u")) & (F.col("segment") == F.col("_s")), how)


def _live(spark: SparkSession, path: str, kind: str, state: State) -> DataFrame:
    """Postings or docs that no deletion took out."""
    rows = _table(spark, path, kind, state.adds)
    if not state.deletes:
        return rows
    return _of(rows, _table(spark, path, "dead", state.deletes), "left_anti")


def open_index(spark: SparkSession, path: str) -> Index:
    """The index as of its last commit. Nothing is computed here: tables are
    read when a search asks."""
    meta, state = _meta(spark, path), _state(spark, path)
    _register(spark, path, meta.buckets)
    terms, stats = _table(spark, path, "terms", state.live), _table(spark, path, "stats", state.live)
    if len(state.live) > 1:
        terms = (terms.groupBy("field", "term").agg(F.sum("df").alias("df"))
                 .where(F.col("df") > 0))
    totals = stats.groupBy("field").agg(F.sum("n_docs").alias("n_docs"),
                                        F.sum("total_len").alias("total_len"))
    return Index(docs=_live(spark, path, "docs", state).select("url", "title", "image_url", "page_id"),
                 postings=_live(spark, path, "postings", state).select("field", "term", "url", "tf", "len"),
                 doc_freq=terms.select("field", "term", "df"), field_stats=with_average(totals))
