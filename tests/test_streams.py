"""Log replays (R1-R3), debounce batch vs stream (R4), ingestion."""
import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from quarry.operators import sequence as SQ
from quarry.sources import tables as S
from quarry.streaming import debounce as DB
from quarry.streaming import ingest as IG
from quarry.streaming import replay as RP
from conftest import SF001, SF01

T0 = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, T0 + dt.timedelta(minutes=m), u, t, float(v)) for i, (m, u, t, v) in enumerate(rows)],
        "event_id long, ts timestamp, user_id long, event_type string, value double")


def test_mode_replay_cases(spark):
    ev = _events(spark, [(0, 1, "error", 0), (1, 1, "purchase", 0), (2, 1, "error", 0),
                         (3, 1, "signup", 0), (4, 1, "click", 0), (5, 1, "purchase", 0),
                         (6, 1, "view", 0), (7, 2, "signup", 0)])
    got = [r.mode for r in sorted(RP.mode_replay(ev, block_rows=3).collect(), key=lambda r: r.event_id)]
    assert got == ["both", "pagerank", "pagerank", "bm25", "both", "pagerank", "both", "bm25"]


def _walk(rows):
    """Reference walk (one request at a time, as the front end does)."""
    state, out = {}, {}
    for eid, user, typ, value in rows:
        act = RP.PAGE_ACTION_OF_EVENT[typ]
        cur = state.get(user)
        if act == "query":
            cur = [1, max(-(-int(value // 1) // 10), 1)]
        elif cur is not None and act == "first":
            cur[0] = 1
        elif cur is not None and act == "next":
            cur[0] = min(cur[0] + 1, cur[1])
        elif cur is not None and act == "prev":
            cur[0] = max(cur[0] - 1, 1)
        state[user] = cur
        out[eid] = None if cur is None else cur[0]
    return out


def test_page_replay_blocks_match_walk(spark):
    ev = S.events(spark, SF001)
    rows = sorted(ev.select("event_id", "user_id", "event_type", "value", "ts").collect(),
                  key=lambda r: (r.user_id, r.ts, r.event_id))
    expect = _walk([(r.event_id, r.user_id, r.event_type, r.value) for r in rows])
    for block in (5, 100_000):
        got = {r.event_id: r.page_no for r in RP.page_replay(ev, block_rows=block).collect()}
        assert got == expect


def test_fill_forward_blocks(spark):
    df = spark.createDataFrame([(i, i % 3, None if i % 4 else f"v{i}") for i in range(60)],
                               "id long, g long, v string")
    a = {r.id: r.f for r in SQ.fill_forward(df, ["g"], ["id"], "v", "f", block_rows=2).collect()}
    last = {}
    for i in range(60):
        if i % 4 == 0:
            last[i % 3] = f"v{i}"
        assert a[i] == last.get(i % 3)


def test_debounce_batch_and_stream(spark, tmp_dir):
    gap = "10 minutes"
    ev = _events(spark, [(0, 1, "view", 0), (5, 1, "click", 0), (15, 1, "signup", 0),
                         (25, 1, "error", 0), (26, 2, "view", 0), (300, 1, "view", 0)])
    batch = sorted((r.user_id, r.start_ts, r.event_type) for r in DB.debounce(ev, gap).collect())
    assert batch == [(1, T0, "click"), (1, T0 + dt.timedelta(minutes=15), "signup"),
                     (1, T0 + dt.timedelta(minutes=25), "error"),
                     (1, T0 + dt.timedelta(minutes=300), "view"),
                     (2, T0 + dt.timedelta(minutes=26), "view")]
    src = os.path.join(tmp_dir, "events")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = (DB.debounce_stream(stream, gap, "0 seconds").writeStream.format("memory")
         .queryName("deb").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.user_id, r.start_ts, r.event_type) for r in spark.table("deb").collect())
    # the stream emits a burst once the watermark (latest ts) has passed its end
    assert got == [b for b in batch if b[1] < T0 + dt.timedelta(minutes=300 - 10)]


def test_stream_ingest_equals_batch_and_resumes(spark, tmp_dir):
    from quarry.operators import links as L
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    first, second = pages.where("page_id < 100"), pages.where("page_id >= 100")
    first.write.parquet(os.path.join(src, "a"))
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    IG.ingest(spark, src + "/*", out, ck)
    n1 = spark.read.parquet(out).count()
    second.union(first.limit(5)).write.parquet(os.path.join(src, "b"))   # new pages + repeats
    IG.ingest(spark, src + "/*", out, ck)                                 # resumes from checkpoint
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    expect = sorted(tuple(r) for r in L.distinct_links(pages).collect())
    assert n1 < len(got) and got == expect


def test_page_replay_stream_matches_batch(spark, tmp_dir):
    ev = S.events(spark, SF001)
    # the log arrives in two files, split in time: the state carries over
    cut = ev.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    src = os.path.join(tmp_dir, "ev")
    ev.where(F.col("ts") <= cut).write.parquet(os.path.join(src, "a"))
    ev.where(F.col("ts") > cut).write.parquet(os.path.join(src, "b"))
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
              .parquet(src + "/*"))
    q = (RP.page_replay_stream(stream).writeStream.format("memory").queryName("pages_stream")
         .outputMode("append").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.event_id: r.page_no for r in spark.table("pages_stream").collect()}
    expect = {r.event_id: r.page_no for r in RP.page_replay(ev).collect()}
    assert got == expect


def test_mode_replay_stream_matches_batch(spark, tmp_dir):
    ev = S.events(spark, SF001)
    cut = ev.agg(F.expr("percentile_approx(ts, 0.3)")).first()[0]
    src = os.path.join(tmp_dir, "ev")
    ev.where(F.col("ts") <= cut).write.parquet(os.path.join(src, "a"))
    ev.where(F.col("ts") > cut).write.parquet(os.path.join(src, "b"))
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
              .parquet(src + "/*"))
    q = (RP.mode_replay_stream(stream).writeStream.format("memory").queryName("modes_stream")
         .outputMode("append").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.event_id: r.mode for r in spark.table("modes_stream").collect()}
    expect = {r.event_id: r.mode for r in RP.mode_replay(ev).collect()}
    assert got == expect


def test_page_scan_takes_blocks_of_many_users_in_one_pass():
    """Blocks begin and end anywhere in a batch; each gets the compositions of
    its own requests."""
    import random

    import pyarrow as pa
    rng = random.Random(3)
    rows = [(user, (r - 1) // 4, r) for user in range(30) for r in range(1, rng.randint(1, 11) + 1)]
    moves = [rng.choice([(1, 1, 3), (-1, 1, 3), (0, 1, 1), (0, -9, 9)]) for _ in rows]
    columns = {"user_id": [r[0] for r in rows], "_blk": [r[1] for r in rows], "_r": [r[2] for r in rows],
               "event_id": list(range(len(rows))), "cur_total": [None] * len(rows),
               "s": [m[0] for m in moves], "lo": [m[1] for m in moves], "hi": [m[2] for m in moves]}
    whole = pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()})
    expect, x = [], None
    for (_, _, r), (s, lo, hi) in zip(rows, moves, strict=True):
        x = 2 if (r - 1) % 4 == 0 else x
        x = min(hi, max(lo, x + s))
        expect.append(x)
    for size in (1, 3, 7, len(rows)):
        batches = [whole.slice(i, size) for i in range(0, len(rows), size)]
        got = [min(h, max(lo, 2 + s)) for b in RP._scan(4)(iter(batches))
               for s, lo, h in zip(*(b.column(c).to_pylist() for c in ("ps", "pl", "ph")), strict=True)]
        assert got == expect
