"""Replays of streams that come out of order; the crawl loop's tables."""
import os

import pytest
from pyspark.sql import functions as F

from quarry.streaming import ordered as OR
from quarry.streaming import replay as RP
from quarry.streaming import tables as IT
from tests.conftest import SF001


@pytest.mark.parametrize("walk,batch", [(OR.PageWalk, RP.page_replay), (OR.ModeWalk, RP.mode_replay)])
def test_overlapping_batches_equal_the_log(spark, tmp_dir, walk, batch):
    events = (spark.read.parquet(f"{SF001}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
              .withColumn("user_id", F.col("user_id") % 7).orderBy("ts", "event_id").limit(300)
              .select("user_id", "event_id", "ts", "event_type", "value")).toPandas()
    late = events.iloc[::3]                    # a third comes with the second batch
    first = events.drop(late.index)
    end = events.iloc[:1].assign(user_id=-1, event_id=-1, ts=events["ts"].max() + (events["ts"].max() - events["ts"].min()) * 3)
    whole = spark.createDataFrame(events)
    source = os.path.join(tmp_dir, "in")
    os.makedirs(source)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(source)
    span = int((events["ts"].max() - events["ts"].min()).total_seconds()) + 60
    for part in (first, late, end):
        spark.createDataFrame(part.sample(frac=1, random_state=1)).coalesce(1).write.mode("append").parquet(source)
        q = (OR.ordered_replay(stream, walk(), f"{span} seconds").writeStream.format("parquet")
             .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = {r[0]: r[1] for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    want = {r[0]: r[1] for r in batch(whole).collect()}
    assert got == want and len(got) == 300


def _tables(spark, base):
    return {k: sorted(map(str, (tuple(r) for r in IT.read_table(spark, base, k).collect()))) for k in IT.TABLES}


def test_crawl_tables_survive_a_restart(spark, tmp_dir):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").where("page_id < 40")
    odd = spark.createDataFrame([(901, None, "<p>x</p>"), (902, " ", "<p>x</p>"), (903, "no-host", "<p>x</p>"),
                                 (904, "http://h.example/ok", None)], pages.schema)
    source = os.path.join(tmp_dir, "in")
    parts = [pages.where("page_id < 20").unionByName(odd), pages.where("page_id between 10 and 29"),
             pages.where("page_id >= 25").unionByName(pages.where("page_id >= 25"))]
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(source)
        IT.ingest_tables(spark, source, f"{tmp_dir}/t", f"{tmp_dir}/ck")
    got = _tables(spark, f"{tmp_dir}/t")
    urls = [r.url for r in IT.read_table(spark, f"{tmp_dir}/t", "pages").collect()]
    assert sorted(urls) == sorted(r.url for r in pages.select("url").distinct().collect())
    assert {r.reason for r in IT.read_table(spark, f"{tmp_dir}/t", "bad").collect()} == {"no url", "no host", "no page"}
    counters = {r.batch: (r.rows, r.bad_rows, r.new_pages) for r in IT.read_table(spark, f"{tmp_dir}/t", "counters").collect()}
    assert counters == {0: (24, 4, 20), 1: (20, 0, 10), 2: (30, 0, 10)}
    links = IT.read_table(spark, f"{tmp_dir}/t", "edges").groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in links} == {
        r.batch: r.links for r in IT.read_table(spark, f"{tmp_dir}/t", "counters").collect()}
    # a batch that ran to its end but was not committed runs again
    IT.write_batch(parts[1], 1, f"{tmp_dir}/t")
    assert _tables(spark, f"{tmp_dir}/t") == got


def test_batch_that_failed_half_way_is_written_anew(spark, tmp_dir, monkeypatch):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").where("page_id < 30")
    source = os.path.join(tmp_dir, "in")
    pages.where("page_id < 15").coalesce(1).write.mode("append").parquet(source)
    IT.ingest_tables(spark, source, f"{tmp_dir}/t", f"{tmp_dir}/ck")
    pages.where("page_id >= 10").coalesce(1).write.mode("append").parquet(source)
    put = IT._put

    def dies(df, base, kind, batch):
        if kind == "edges":
            raise RuntimeError("lost")
        put(df, base, kind, batch)

    monkeypatch.setattr(IT, "_put", dies)
    with pytest.raises(Exception, match="lost"):
        IT.ingest_tables(spark, source, f"{tmp_dir}/t", f"{tmp_dir}/ck")
    monkeypatch.setattr(IT, "_put", put)
    IT.ingest_tables(spark, source, f"{tmp_dir}/t", f"{tmp_dir}/ck")
    assert IT.read_table(spark, f"{tmp_dir}/t", "pages").count() == 30
    assert {r.batch: r.new_pages for r in IT.read_table(spark, f"{tmp_dir}/t", "counters").collect()} == {0: 15, 1: 15}


def test_folder_names_with_glob_signs(spark, tmp_dir):
    from quarry.streaming import ingest as IG
    folder = os.path.join(tmp_dir, "a[1]{b}*")
    spark.read.parquet(f"{SF001}/pages.parquet").limit(5).coalesce(1).write.parquet(f"{folder}/pages.parquet")
    IT.ingest_tables(spark, IG.one_table(f"{folder}/pages.parquet"), f"{tmp_dir}/t", f"{tmp_dir}/ck")
    assert IT.read_table(spark, f"{tmp_dir}/t", "pages").count() == 5
