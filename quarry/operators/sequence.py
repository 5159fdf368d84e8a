"""Order-dependent building blocks that stay parallel when one group holds
a large share of the rows.

A ``Window.partitionBy(g).orderBy(o)`` sends each group to one task; with a
group holding a third of all rows, that task does a third of the work. The
helpers here order rows with a global sort instead (range partitioning cuts
a hot group across many tasks) and number them from per-partition counts —
a table with one row per partition, so its size is bounded by the partition
count, never by the data:

* ``global_rank``  — 1-based position of each row in a total order;
* ``group_rank``   — position within a group: counted where the sorted rows
  lie, plus what earlier partitions hold of a partition's first group;
* ``next_in_group`` — the following row of the same group, by an equi-join
  on position (unique keys, no skew);
* ``fill_forward`` — last non-null value so far within a group, as a
  two-level scan over fixed-size blocks of positions.

Sorted, numbered rows are frozen with a reliable ``checkpoint()`` (into
``spark.checkpoint.dir``) so that a recomputed partition cannot change its
numbering after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

BLOCK_ROWS = 100_000


def global_rank(df: DataFrame, order: list[Column | str], name: str = "pos") -> DataFrame:
    """Add ``name``: 1-based position of each row in ``order`` (the order
    must be total — break ties with a unique column)."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (df.sort(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                        F.min("_mid").alias("_m0"))
    # one row per partition: the running offset is computed in one small task
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (tagged.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("long"))
            .drop("_pid", "_mid", "_off", "_m0"))


def _leaves(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns as simple values (fields of structs apart)."""
    out = []
    for name in names:
        kind = df.select(name).schema[0].dataType
        if kind.typeName() == "struct":
            out += _leaves(df, [f"{name}.{f.name}" for f in kind.fields])
        else:
            out.append(F.col(name))
    return out


def _counted(sorted_rows: DataFrame, leaves: list[Column]) -> DataFrame:
    """Adds to sorted rows: ``_pid`` and ``_at``, the partition and the place
    in it, ``_k``, the place in the run of equal ``leaves``, and ``_head``,
    whether that run is the partition's first."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

    columns = sorted_rows.columns
    marks = [f"_leaf{i}" for i in range(len(leaves))]
    made = [StructField("_pid", IntegerType()), StructField("_at", LongType()),
            StructField("_k", LongType()), StructField("_head", BooleanType())]

    def run(batches):
        from pyspark import TaskContext
        pid, at, k, head, last = TaskContext.get().partitionId(), 0, 0, True, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)  # where a run begins
            for m in marks:
                c = batch.column(m)
                differ = pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), False)
                gap = pc.xor(pc.is_null(c.slice(1)), pc.is_null(c.slice(0, n - 1)))
                new[1:] |= pc.or_(differ, gap).to_numpy(zero_copy_only=False)
            first = [batch.column(m)[0].as_py() for m in marks]
            new[0] = last is not None and first != last
            last = [batch.column(m)[n - 1].as_py() for m in marks]
            place = np.arange(n)
            starts = np.flatnonzero(new)
            begin = np.searchsorted(starts, place, side="right") - 1
            own = np.where(begin >= 0, place - starts[begin] + 1 if len(starts) else 0, place + 1 + k)
            flag = np.full(n, head) & (begin < 0)
            k, head = int(own[-1]), bool(flag[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array(np.full(n, pid, np.int32)), pa.array(at + place + 1), pa.array(own),
                   pa.array(flag)], names=[*columns, *(f.name for f in made)])
            at += n

    wide = sorted_rows.select("*", *[c.alias(m) for c, m in zip(leaves, marks, strict=True)])
    return wide.mapInArrow(run, StructType(sorted_rows.schema.fields + made))


def group_rank(df: DataFrame, group: list[str], order: list[Column | str],
               name: str = "rank") -> DataFrame:
    """Add ``name``: 1-based position within ``group`` in ``order``, plus
    the global position ``_gpos``.

    The rows move once, in the sort. Then every partition counts its runs of
    equal groups; only its first group can have begun before, so what is added
    is one number per partition (a table with a row per partition)."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = _counted(df.sort(*group, *order), _leaves(df, group)).checkpoint(eager=True)
    g = F.struct(*group)
    parts = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.min_by(g, "_at").alias("first"),
                                     F.max_by(g, "_at").alias("last"), F.max_by("_k", "_at").alias("k"))
    sofar = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("n").over(sofar), F.lit(0)))
    # rows of a partition's first group in earlier partitions: those end with it
    sides = F.explode(F.array(
        F.struct(F.col("first").alias("g"), F.lit(0).alias("end"), F.lit(0).cast("long").alias("add")),
        F.struct(F.col("last").alias("g"), F.lit(1).alias("end"), F.col("k").alias("add"))))
    before = Window.partitionBy("s.g").orderBy("_pid", "s.end").rowsBetween(Window.unboundedPreceding, -1)
    carry = (parts.select("_pid", "_off", sides.alias("s"))
             .withColumn("_carry", F.coalesce(F.sum("s.add").over(before), F.lit(0)))
             .where("s.end = 0").select("_pid", "_off", "_carry"))
    return (rows.join(F.broadcast(carry), "_pid")
            .withColumn(name, F.col("_k") + F.when(F.col("_head"), F.col("_carry")).otherwise(0))
            .withColumn("_gpos", F.col("_off") + F.col("_at"))
            .drop("_pid", "_at", "_k", "_head", "_carry", "_off"))


def next_in_group(df: DataFrame, group: list[str], order: list[Column | str],
                  value: str, name: str = "next") -> DataFrame:
    """Add ``name``: ``value`` of the next row of the same group (null for
    the last row of a group)."""
    ranked = global_rank(df, [*group, *order], "_gpos")
    nxt = ranked.select(*[F.col(g).alias(f"_n_{g}") for g in group],
                        (F.col("_gpos") - 1).alias("_gpos"), F.col(value).alias(name))
    j = ranked.join(nxt, "_gpos", "left")
    same = F.lit(True)
    for g in group:
        same = same & (F.col(g) == F.col(f"_n_{g}"))
    return (j.withColumn(name, F.when(same, F.col(name)))
            .drop("_gpos", *[f"_n_{g}" for g in group]))


def fill_forward(df: DataFrame, group: list[str], order: list[Column | str],
                 value: str, name: str, block_rows: int = BLOCK_ROWS,
                 ranked: str | None = None) -> DataFrame:
    """Add ``name``: the last non-null ``value`` at or before each row in its
    group (null before the first one).

    Positions are cut into blocks of ``block_rows``; a window per
    (group, block) holds at most ``block_rows`` rows, and the carry into a
    block comes from a window over per-block summaries — one row per block,
    so a group of n rows contributes n / block_rows rows there. ``ranked``
    names a column that already holds the 1-based position within the group
    (then ``order`` is not used and no new sort runs).
    """
    if ranked is None:
        base = group_rank(df, group, order, "_ffr").drop("_gpos")
    else:
        base = df.withColumn("_ffr", F.col(ranked))
    blk = base.withColumn("_blk", F.floor((F.col("_ffr") - 1) / block_rows))
    upto = (Window.partitionBy(*group, "_blk").orderBy("_ffr")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = blk.withColumn("_loc", F.last(value, ignorenulls=True).over(upto))
    summary = (blk.where(F.col(value).isNotNull())
               .groupBy(*group, "_blk").agg(F.max_by(value, "_ffr").alias("_last")))
    blocks = (blk.select(*group, "_blk").distinct()
              .join(summary, [*group, "_blk"], "left"))
    earlier = (Window.partitionBy(*group).orderBy("_blk")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = blocks.withColumn("_in", F.last("_last", ignorenulls=True).over(earlier))
    out = (local.join(carry.select(*group, "_blk", "_in"), [*group, "_blk"])
           .withColumn(name, F.coalesce(F.col("_loc"), F.col("_in"))))
    return out.drop("_ffr", "_blk", "_loc", "_in")
