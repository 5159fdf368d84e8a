"""Result view and link health."""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.constants import FAILED_STATUS, REDIRECT_PREFIX
from quarry.sources.tables import literal_table

# Every registered HTTP status with its description.
HTTP_CODES = tuple((s.value, s.phrase) for s in HTTPStatus)


def result_view(hits: DataFrame, docs: DataFrame, images: DataFrame,
                prefix: str = REDIRECT_PREFIX) -> DataFrame:
    """Hits ``(query_id, url, rank)`` with their stored title, the
    redirect link and the page image (null when the page has none)."""
    return (hits.join(docs.select("url", "title"), "url", "left")
            .join(images.select("url", "image_url"), "url", "left")
            .select("query_id", "rank", "title",
                    F.concat(F.lit(prefix), F.col("url")).alias("link"), "image_url"))


def link_health(urls: DataFrame, statuses: DataFrame) -> DataFrame:
    """F8: ``urls(url)`` ⟕ ``statuses(url, status)``; a URL without a status
    counts as a failed request. The status text comes from the table of HTTP
    statuses (some 60 rows, broadcast). ``(url, status, ok, description)``"""
    spark = urls.sparkSession
    codes = F.broadcast(literal_table(spark, list(HTTP_CODES), "status int, description string"))
    return (urls.join(statuses.select("url", "status"), "url", "left")
            .withColumn("status", F.coalesce(F.col("status"), F.lit(FAILED_STATUS)).cast("int"))
            .join(codes, "status", "left")
            .select("url", "status", (F.col("status") == 200).alias("ok"), "description"))
