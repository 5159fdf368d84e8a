"""Embedding whitening with distributed block matrices.

Entries become integers ``x = floor(64 c) + 1000000``; the fit list holds every
distinct x vector once. Its rows, centred by the exact sums, are packed into
the dense row blocks of a ``BlockMatrix``: a task packs its own rows, so that no
row is shuffled for it. The transposed matrix times the matrix is the scatter
(blocks spread over many middle splits, summed); ``eigh`` of that one small
matrix on the driver gives the whitening matrix, and one more multiplication
projects the blocks of all rows. Blocks are written as Parquet structs and read
as MLlib matrices, and the other way round, so rows never pass through Python
objects. How far the whitened fit list is from unit covariance is measured on
its projected rows.

Edge cases: rows whose vector is null or holds a null, NaN or infinite entry
are dropped, and so are vectors that are shorter than the longest; null and
repeated ids are kept, one result per row; repeated vectors count once in the
fit; directions without variance (eigenvalue below ``RANK`` times the largest)
are no components, so an empty table, a single distinct vector or constant
columns give fewer components or none; a deviation beyond 64 bits is null;
other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StructField, StructType)

from quarry.llm.common import arrow_schema, stored, written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BLOCK_ROWS = 256            # rows of a block, at least
BLOCKS = 65_536             # blocks wished for at most: their places pass the driver
BLOCK_BYTES = 4 << 20       # size of a block at most (a row at least)
TASK_BLOCKS = 4             # blocks that a packing task should fill, at least
SPLIT_BYTES = 32 << 20      # blocks that one middle split multiplies, about
RANK = 1e-11                # eigenvalues below this share of the largest count as 0

#: A dense matrix as Parquet holds it.
MATRIX = ("struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,"
          "rowIndices:array<int>,values:array<double>,isTransposed:boolean>")


@dataclass
class Fit:
    """What the fit list says: exact count and sums, components, eigenvalues."""
    n: int
    sums: list[int]
    matrix: np.ndarray      # whitening matrix, dimensions x components
    explained: np.ndarray   # share of the trace per component


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x) of the rows whose vector is whole and finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: F.abs(c.cast("double")) < float("inf"))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    return vectors.where(v.isNotNull() & finite).select(F.col(key).alias("key"), x.alias("x"))


def rows_of(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows of the fit list and its exact sums, one row per dimension to the
    driver."""
    out = arrow_schema("dim int, n long, s long")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, batch.num_rows)),
                     pa.array(rows_of(batch, d).sum(axis=0))], schema=out)

    got = (fit.select("x").mapInArrow(run, "dim int, n long, s long").groupBy("dim")
           .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    got.sort(key=lambda r: r.dim)
    return (got[0].n, [int(r.s) for r in got]) if got else (0, [])


def block_rows(n: int, d: int) -> int:
    return max(1, min(max(BLOCK_ROWS, -(-n // BLOCKS)), BLOCK_BYTES // (8 * d)))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list]:
    """(centred rows, exact sums of squares of n x - S or None beyond 64 bits)."""
    base = [s // n for s in sums]
    near = x - np.array(base, np.int64)              # small numbers
    rest = [s - n * b for s, b in zip(sums, base, strict=True)]
    rough = near.astype(float) - np.array(rest, float) / n
    size = (rough * n) ** 2
    if not size.size or size.sum(axis=1).max() < 2.0 ** 62:
        t = near * n - np.array(rest, np.int64)
        return t / n, (t * t).sum(axis=1).tolist()
    own = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in near.tolist()]
    return rough, [v if v < 2 ** 63 else None for v in own]


def packed(rows: DataFrame, d: int, n: int, sums: list[int], size: int, count: int,
           name: str) -> str:
    """Centred rows packed into dense blocks of ``size`` rows, with the keys and
    deviations of their rows and a number ``i`` from 0; the path of the table.
    Short blocks are filled up with zero rows. ``count``: rows, about."""
    key = rows.schema["key"].dataType
    schema = StructType([
        StructField("pid", IntegerType()), StructField("k", IntegerType()),
        StructField("keys", ArrayType(key)), StructField("deviations", ArrayType(LongType())),
        *StructType.fromDDL(f"m {MATRIX}").fields])
    arrow = arrow_schema(f"m {MATRIX}")
    key_type = rows.limit(0).toArrow().schema.field("key").type

    def run(batches):
        from pyspark import TaskContext
        pid, number, waiting, have = TaskContext.get().partitionId(), 0, [], 0

        def block(parts):
            nonlocal number
            keys = pa.concat_arrays([k for k, _ in parts])
            x = np.concatenate([v for _, v in parts])
            centred, own = deviations(x, n, sums)
            m = np.zeros((size, d))
            m[:len(centred)] = centred
            matrix = {"type": 1, "numRows": size, "numCols": d, "colPtrs": None, "rowIndices": None,
                      "values": m.ravel(order="F"), "isTransposed": False}
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([number - 1], pa.int32()),
                 pa.ListArray.from_arrays([0, len(keys)], keys),
                 pa.array([own], pa.list_(pa.int64())), pa.array([matrix], arrow.field("m").type)],
                names=["pid", "k", "keys", "deviations", "m"])

        for batch in batches:
            keys, x, at = batch.column("key").cast(key_type), rows_of(batch, d), 0
            while at < len(x):
                take = min(size - have, len(x) - at)
                waiting.append((keys.slice(at, take), x[at:at + take]))
                have, at = have + take, at + take
                if have == size:
                    yield block(waiting)
                    waiting, have = [], 0
        if have:
            yield block(waiting)

    # few tasks with several blocks each: filling up costs little
    tasks = max(1, min(rows.rdd.getNumPartitions(), count // (TASK_BLOCKS * size)))
    made = stored(rows.coalesce(tasks).mapInArrow(run, schema), f"{name}-blocks")
    # number of the first block of a task: a row per task
    first = (made.groupBy("pid").agg(F.count(F.lit(1)).alias("c"))
             .select("pid", F.expr("coalesce(sum(c) OVER (ORDER BY pid ROWS BETWEEN "
                                   "UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("first")))
    i = (F.col("first") + F.col("k")).cast("long")
    return written(made.join(first, "pid").select(i.alias("i"), "keys", "deviations", "m"), name)


def as_matrix(spark: SparkSession, path: str, d: int, size: int) -> BlockMatrix:
    """The blocks (``size`` rows each) of a table made by ``packed`` as a
    BlockMatrix."""
    schema = StructType([StructField("i", LongType()), StructField("m", MatrixUDT())])
    blocks = spark.read.schema(schema).parquet(path)
    count = blocks.count()
    place = F.struct(F.col("i").alias("_1"), F.lit(0).cast("long").alias("_2"))
    java = callMLlibFunc("createBlockMatrix", blocks.select(place.alias("_1"), F.col("m").alias("_2")),
                         size, d, count * size, d)
    return BlockMatrix(java, size, d)


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left`` times ``right``; the middle dimension is dealt over ``splits``
    tasks per block of the result (the Python method has no such argument)."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def whitening(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, explained) of the covariance ``scatter / n``."""
    cov = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [j for j in range(min(components, len(values))) if values[j] > max(RANK * values[0], 0)]
    vectors = vectors[:, keep]
    big = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[big, np.arange(len(keep))] < 0, -1.0, 1.0)
    return vectors / np.sqrt(values[keep]), values[keep] / np.trace(cov)


def projected(blocks: BlockMatrix, matrix: np.ndarray, spark: SparkSession, name: str) -> DataFrame:
    """(i, z) of the blocks times ``matrix``, written."""
    d, k = matrix.shape
    one = spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, k, matrix.ravel(order="F")))], 1)
    java = product(blocks, BlockMatrix(one, d, k), 1)._java_matrix_wrapper._java_model
    path = written(callMLlibFunc("getMatrixBlocks", java), name)
    return (spark.read.schema(f"_1 struct<_1:int,_2:int>, _2 {MATRIX}").parquet(path)
            .select(F.col("_1._1").cast("long").alias("i"), F.col("_2").alias("z")))


def block_array(z: dict) -> np.ndarray:
    order = "C" if z["isTransposed"].as_py() else "F"
    values = z["values"].values.to_numpy(zero_copy_only=False)
    return values.reshape((z["numRows"].as_py(), z["numCols"].as_py()), order=order)


def covariance_error(z: DataFrame, n: int, k: int) -> float:
    """Largest entry of |covariance - identity| of the projected fit list
    (rows that fill up blocks are zero and count for nothing)."""
    def run(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            for m in batch.column("z"):
                m = block_array(m)
                total[:k] += m.T @ m
                total[k] += m.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "s"])

    got = z.select("z").mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros((k + 1) * k)
    for r in got:
        flat[r.at] = r.s
    total = flat.reshape(k + 1, k)
    mean = total[k] / n
    return float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id",
           vector: str = "embedding") -> tuple[DataFrame, Fit | None, float]:
    """((i, keys, deviations, z) per block of rows, the fit, identity error);
    the fit is None where there is nothing to whiten."""
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, key, vector), "vectors")
    facts = rows.agg(F.max(F.size("x")).alias("d")).first()
    d = facts.d or 0
    empty = spark.createDataFrame([], StructType([
        StructField("i", LongType()), StructField("keys", ArrayType(rows.schema["key"].dataType)),
        *StructType.fromDDL(f"deviations array<long>, z {MATRIX}").fields]))
    if not d:
        return empty, None, 0.0
    rows = rows.where(F.size("x") == d)
    fit = stored(rows.select("x").distinct(), "fit")
    n, sums = exact_sums(fit, d)
    fit_rows = fit.select(F.lit(None).cast("long").alias("key"), "x")
    size = block_rows(n, d)
    fit_blocks = as_matrix(spark, packed(fit_rows, d, n, sums, size, n, "fit"), d, size)
    splits = math.ceil(16 * d * n / SPLIT_BYTES)
    splits = min(max(splits, spark.sparkContext.defaultParallelism), fit_blocks.numRowBlocks)
    scatter = product(fit_blocks.transpose(), fit_blocks, splits).toLocalMatrix().toArray()
    matrix, explained = whitening(scatter, n, components)
    if not matrix.shape[1]:
        return empty, None, 0.0
    error = covariance_error(projected(fit_blocks, matrix, spark, "fit-z"), n, matrix.shape[1])
    count = rows.count()
    size = block_rows(count, d)
    path = packed(rows, d, n, sums, size, count, "rows")
    z = projected(as_matrix(spark, path, d, size), matrix, spark, "z")
    kept = spark.read.parquet(path).select("i", "keys", "deviations")
    return kept.join(z, "i"), Fit(n, sums, matrix, explained), error


def op13_whitening(vectors: DataFrame) -> DataFrame:
    blocks, fit, error = whiten(vectors)
    schema = StructType([
        StructField("vec_id", vectors.schema["vec_id"].dataType),
        *StructType.fromDDL("component int, n long, deviation long, whitened double, "
                            "explained double, identity_error double").fields])
    if fit is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k, n, share = fit.matrix.shape[1], fit.n, fit.explained

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                keys = batch.column("keys")[row].values
                own = batch.column("deviations")[row].values
                count = len(keys)
                place = np.repeat(np.arange(count), k)
                z = block_array(batch.column("z")[row])[:count]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(place)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                     pa.array(np.full(count * k, n)), own.take(pa.array(place)),
                     pa.array(np.ascontiguousarray(z).ravel()), pa.array(np.tile(share, count)),
                     pa.array(np.full(count * k, error))], names=schema.names)

    return blocks.mapInArrow(run, schema)
