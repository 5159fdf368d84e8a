"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes cuts a text where it hits the trigger value of
the block size; every chunk gives one character of the signature. The block
size doubles until about 64 chunks are left, and a fingerprint
``block:signature:signature at twice the block`` holds two of them, so texts
of unlike length stay comparable. Fingerprints compare by edit distance where
they share a block size and a run of ``COMMON`` characters.

Edge cases: a null text is the empty text (fingerprint ``3::``); equal texts
have equal fingerprints and likeness 1; repeated rows and equal ids are ordered
by their text; null ids come last; the only document of a table is its own
next one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_schema, slices, stored, texts_of

SMALLEST = 3    # smallest block size
LENGTH = 64     # characters of a signature at most
WINDOW = 7      # bytes of the rolling hash
COMMON = 5      # run that signatures must share to be compared
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def rolling_hash(data: bytes) -> np.ndarray:
    """Hash of the (up to) WINDOW bytes that end at each position."""
    n = len(data)
    a = np.zeros(n + WINDOW - 1, np.uint32)
    a[WINDOW - 1:] = np.frombuffer(data, np.uint8)
    h = np.zeros(n, np.uint32)
    mix = np.zeros(n, np.uint32)
    for age in range(WINDOW):
        b = a[WINDOW - 1 - age:WINDOW - 1 - age + n]
        h += b * np.uint32(WINDOW - age + 1)
        mix ^= b << np.uint32(5 * age % 32)
    return h + mix * np.uint32(2654435761)


def signature(data: bytes, ends: np.ndarray) -> str:
    """One character per chunk; the last one takes all that is left."""
    view, start, out = memoryview(data), 0, []
    for end in (ends[:LENGTH - 1] + 1).tolist():
        out.append(ALPHABET[zlib.crc32(view[start:end]) & 63])
        start = end
    if start < len(data):
        out.append(ALPHABET[zlib.crc32(view[start:]) & 63])
    return "".join(out)


def fingerprint(text: str) -> str:
    data = text.encode("utf-8", "surrogatepass")
    block = SMALLEST
    while block * LENGTH < len(data):
        block *= 2
    h = rolling_hash(data)
    ends = np.flatnonzero(h % np.uint32(block) == block - 1)
    while block > SMALLEST and len(ends) < LENGTH // 2:
        block //= 2
        ends = np.flatnonzero(h % np.uint32(block) == block - 1)
    wide = ends[h[ends] % np.uint32(2 * block) == 2 * block - 1]
    return f"{block}:{signature(data, ends)}:{signature(data, wide)}"


def _likeness(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 without a shared run."""
    def runs(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - (COMMON - 1), F.lit(1))),
                           lambda i: F.substring(s, i, F.lit(COMMON)))
    near = 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))
    return F.when(a == b, 1.0).when(F.arrays_overlap(runs(a), runs(b)), near).otherwise(0.0)


def likeness(a: Column, b: Column) -> Column:
    """Likeness (0 to 1) of two fingerprints: the better of the signatures at
    a block size that both have; 0 where they have none."""
    pa_, pb = F.split(a, ":"), F.split(b, ":")
    ba, bb = pa_[0].cast("long"), pb[0].cast("long")
    return (F.when(a == b, 1.0)
            .when(ba == bb, F.greatest(_likeness(pa_[1], pb[1]), _likeness(pa_[2], pb[2])))
            .when(ba == 2 * bb, _likeness(pa_[1], pb[2]))
            .when(bb == 2 * ba, _likeness(pa_[2], pb[1]))
            .otherwise(0.0))


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) characters replaced by the next text's first."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


ROW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, next_fingerprint string")
EDGES = f"{ROW}, part int, kind string, text string"


def _result(doc_id, text: str, own: str, following: str, next_fp: str) -> dict:
    new = edited(text, following)
    return {"doc_id": doc_id, "n_chars": len(text), "fingerprint": own,
            "edited_sha256": hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
            "edited_fingerprint": fingerprint(new), "next_fingerprint": next_fp}


def _as_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _scan(batches, schema: pa.Schema):
    """Sorted rows of one partition: a result for every row but the last, and
    the first and last rows themselves for the join across partitions."""
    part, before = TaskContext.get().partitionId(), None
    for batch in slices(batches):
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
            own = fingerprint(text)
            if before is None:
                out.append({"part": part, "kind": "first", "text": text, "fingerprint": own})
            else:
                out.append({"kind": "row"} | _result(*before, text, own))
            before = doc_id, text, own
        yield _as_batch(out, schema)
    if before is not None:
        yield _as_batch([{"part": part, "kind": "last", "doc_id": before[0], "text": before[1],
                          "fingerprint": before[2]}], schema)


def _join_edges(batches, schema: pa.Schema):
    for batch in batches:
        yield _as_batch([_result(r["doc_id"], r["text"], r["fingerprint"], r["next_text"],
                                 r["next_fingerprint"]) for r in batch.to_pylist()], schema)


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, its edited text and the next text by
    descending id. One range partitioning of the texts; only the first and
    last row of each partition are joined afterwards."""
    spark = docs.sparkSession
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order)
               .sortWithinPartitions(*order, "text").drop("tie"))
    done = stored(ordered.mapInArrow(partial(_scan, schema=arrow_schema(EDGES)), EDGES), "fingerprints")
    firsts = done.where("kind = 'first'")
    parts = sorted(r.part for r in firsts.select("part").collect())  # one number per partition
    links = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)),
                                  "part int, next_part int")
    lasts = (done.where("kind = 'last'").select("part", "doc_id", "text", "fingerprint")
             .join(links, "part")
             .join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"),
                                 F.col("fingerprint").alias("next_fingerprint")), "next_part"))
    columns = [c.split()[0] for c in ROW.split(", ")]
    return (done.where("kind = 'row'").select(*columns)
            .unionByName(lasts.drop("part", "next_part").mapInArrow(
                partial(_join_edges, schema=arrow_schema(ROW)), ROW)))


def op9_fingerprint(docs: DataFrame) -> DataFrame:
    return with_next(docs).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
