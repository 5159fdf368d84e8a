"""Loaders for the input tables.

Every loader returns a lazy DataFrame over parquet, so Catalyst prunes the
columns a plan does not use (``html`` stays out of every plan that does not
read it) and pushes filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus: ``page_id BIGINT, url STRING, html STRING``."""
    return table(spark, sf_dir, "pages")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request/event log; ``ts`` cast to TIMESTAMP so watermarks accept it."""
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table built inside the JVM (a literal array of structs
    turned into rows) — no Python data transfer, no Python workers. For
    parameter tables (rules, code lists), not for data."""
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
