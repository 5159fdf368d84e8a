"""Helpers shared by the operators: tables written to the shared folder,
bounded labelled samples, Arrow batches cut into slices of bounded text."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import scratch_path, ship_package

#: Characters of text that one slice of a batch holds at most (or one row).
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the package is shipped for Python workers."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str | None = None) -> str:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir``; the path.
    ``compression``: another one than the session's."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path, compression=compression)
    return path


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back:
    cuts the lineage with files that survive a lost executor."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name, compression))


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        parents = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in parents:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod ``n`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def smallest(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the smallest ``h``, a 64-bit hash. All but about
    the 2n smallest are filtered out in their tasks first, so that what
    reaches the driver does not grow with the number of tasks."""
    total = df.count()
    if total > 4 * n:
        df = df.where(F.col("h") < int(-2 ** 63 + 2 ** 64 * (2 * n / total)))
    return df.orderBy("h").limit(n)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: Column,
                    per_class: dict[int, int]) -> list[tuple[str, int]]:
    """At most ``per_class[y]`` (text, y) rows of each class for training.

    ``fold`` (over ``doc_id``) marks the rows that may be used. Ids with a
    null label are left out; an id labelled twice counts with its larger
    label. The rows taken are those with the smallest hash of the id, so the
    sample does not depend on row order or partitioning. Both the id list and
    the returned rows are bounded by ``per_class``, also when ids repeat.
    """
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & fold)
           .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
           .withColumn("h", F.xxhash64("doc_id")))
    out: list[tuple[str, int]] = []
    for y, n in sorted(per_class.items()):
        picked = smallest(ids.where(F.col("y") == y), n)
        rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                .join(F.broadcast(picked.select("doc_id", "h")), "doc_id")  # n rows at most
                .orderBy("h", "doc_id", F.xxhash64("text")).limit(n).select("text"))
        out += [(r.text, y) for r in rows.collect()]
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text of a slice is bounded."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                         .to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, base + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string (on the driver: the JVM parses it)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(StructType.fromDDL(ddl))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str,
             column: str = "text", keep_text: bool = False) -> DataFrame:
    """``mapInArrow`` over text-bounded slices: ``fn`` gives the new columns of
    a slice; the columns of ``df`` are carried along in front of them,
    ``column`` itself only with ``keep_text``. ``schema`` declares the new
    columns."""
    keep = [f for f in df.schema.fields if keep_text or f.name != column]
    out = StructType(keep + StructType.fromDDL(schema).fields)
    kinds = [(f.name, f.type) for f in arrow_schema(schema)]
    names = [f.name for f in keep]

    def run(batches):
        for part in slices(batches, column):
            new = fn(part)
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [pa.array(new[n], type=t) for n, t in kinds],
                names=names + [n for n, _ in kinds])

    return df.mapInArrow(run, out)


def rows_where(docs: DataFrame, score: Callable[[DataFrame], DataFrame], made: list[str],
               condition: Column) -> DataFrame:
    """The rows of ``docs`` whose scored form meets ``condition``, with the
    columns of ``docs``; ``made`` are the columns that ``score`` adds, which
    may clash with those of ``docs``."""
    own = {c: f"_own_{c}" for c in docs.columns if c in made}
    kept = score(docs.withColumnsRenamed(own)).where(condition).drop(*made)
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)
