"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and
returns what goes on: its rows are written as Parquet below
``spark.checkpoint.dir`` and read again as the next stage's documents.

1. toxicity: documents scored 0.7 or more by the noisy-or model go.
2. quality: documents that the line CRF scores below 0.3 go.
3. near duplicates: of every component of documents whose 5-word shingles have
   a Jaccard similarity of 0.75 or more, the one with the smallest id stays.
4. secrets: every span that a secret rule finds is replaced by a mark.
5. packing: what is left is tokenised and packed into sequences of 4096.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import jaccard, packing, quality_crf, secrets, toxicity
from quarry.llm.common import stored, table

#: Trained models, a tokenizer and a genetic search: not expressible in SQL.
#: tests/llm holds run() against a plain Python version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_crf.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.op3_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near duplicates", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one
    before; the rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
