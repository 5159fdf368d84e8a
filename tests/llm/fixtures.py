"""Small tables that hold the awkward cases every operator must bear."""
import random

LONG = "lorem ipsum dolor sit amet " * 4000

#: doc_id, text, source; with nulls, empty and very long texts, copies.
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "a"), (4, "one two", "a"),
    (None, "a text without an id, said once", "b"), (5, LONG, "b"), (6, "é ß 😀 naïve", "b"),
    (7, "x" * 3000, "a"),
]
SCHEMA = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def frame(spark, rows=None, clash=()):
    """The rows as documents; ``clash`` adds columns of those names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD if rows is None else rows, SCHEMA)
    df = df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    for name in clash:
        df = df.withColumn(name, F.lit("clash"))
    return df


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    return " ".join(rng.choice(words) for _ in range(n))
