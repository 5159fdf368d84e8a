"""Replays of the per-user state the web front end keeps in process globals
(R1-R3): scoring mode, last query, page position — computed for every
request of a log at once.

Each state is a scan over a user's requests in time order. The scans run on
the sequencing helpers (global sort + per-partition numbering), so a user
with a third of all requests is spread over many tasks:

* R1 and R2 are "last value so far" scans (``fill_forward``);
* R3 is a clamped walk (next/previous page bounded by 1 and the last page).
  Each request is a function ``x -> min(hi, max(lo, x + s))``; these compose
  into the same form, so blocks of at most ``block_rows`` requests are
  scanned locally, those of many users in one pass, and only one summary per
  full block is scanned per user.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.constants import PAGE_LEN
from quarry.operators import sequence as SQ

# --- fixed values: event types of the log mapped to front-end actions ---------
# R1 checkbox requests: view = home page opened (mode reset to both),
# click = both boxes ticked, purchase = PageRank only, signup = BM25 only,
# error = neither ticked (the previous mode stays).
MODE_OF_EVENT = {"view": "both", "click": "both", "purchase": "pagerank",
                 "signup": "bm25", "error": None}
# R3 page requests: view = new query submitted (page 1, its hit count is the
# event value), click = next page, purchase = previous page, signup = first
# page, error = invalid page request (the last query is searched again: page 1).
PAGE_ACTION_OF_EVENT = {"view": "query", "click": "next", "purchase": "prev",
                        "signup": "first", "error": "first"}

_BIG = 1 << 40


def _case(col, mapping):
    expr = None
    for k, v in mapping.items():
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(col == k, lit) if expr is None else expr.when(col == k, lit)
    return expr


def mode_replay(events: DataFrame, block_rows: int = SQ.BLOCK_ROWS) -> DataFrame:
    """Scoring mode in force after each request: ``(event_id, mode)``.
    Users start in 'both'."""
    e = events.select("event_id", "user_id", "ts",
                      _case(F.col("event_type"), MODE_OF_EVENT).alias("set_mode"))
    f = SQ.fill_forward(e, ["user_id"], ["ts", "event_id"], "set_mode", "m", block_rows)
    return f.select("event_id", F.coalesce(F.col("m"), F.lit("both")).alias("mode"))


def query_replay(requests: DataFrame, block_rows: int = SQ.BLOCK_ROWS) -> DataFrame:
    """R2: a request without ``q`` searches the session's last query:
    ``requests(session, seq, q)`` → ``(session, seq, q)``. Where ``requests``
    has a column ``home`` and it is true, the home page is opened: the last
    query is forgotten."""
    if "home" in requests.columns:
        home = F.coalesce("home", F.lit(False))
        known = F.when(home, F.struct(F.lit(None).cast("string").alias("q"))) \
            .when(F.col("q").isNotNull(), F.struct("q"))
        f = SQ.fill_forward(requests.withColumn("_set", known), ["session"], ["seq"], "_set", "_eff", block_rows)
        return f.select("session", "seq", F.col("_eff.q").alias("q"))
    f = SQ.fill_forward(requests, ["session"], ["seq"], "q", "q_eff", block_rows)
    return f.select("session", "seq", F.col("q_eff").alias("q"))


# ----------------------------------------------------------------- R3 -------

def _compose(a, b):
    """b after a, for clamp functions (s, lo, hi) on numpy arrays or scalars."""
    s1, l1, h1 = a
    s2, l2, h2 = b
    return (s1 + s2, np.minimum(h2, np.maximum(l2, l1 + s2)),
            np.minimum(h2, np.maximum(l2, h1 + s2)))


def _apply(f, x):
    s, lo, hi = f
    return np.minimum(hi, np.maximum(lo, x + s))


SCANNED = "user_id long, _blk long, _r long, event_id long, cur_total long, ps long, pl long, ph long"


def _scan(block_rows: int):
    """Prefix compositions inside every block of a partition's rows, which are
    sorted by (user_id, _blk, _r): many users' blocks in one pass over a batch.
    A block begins where ``_r``, which has no gaps, passes its multiple; what a
    batch leaves of an unfinished block goes into the next batch."""
    def run(batches):
        carry = None  # composition of the last block so far
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            r = batch.column("_r").to_numpy()
            acc = [batch.column(c).to_numpy().copy() for c in ("s", "lo", "hi")]
            at = np.arange(n)
            first = (r - 1) % block_rows == 0
            start = np.maximum.accumulate(np.where(first, at, 0))
            # after the pass with a given step every place holds the last 2 * step requests
            step, place = 1, at[at - 1 >= start]
            while len(place):
                both = _compose([v[place - step] for v in acc], [v[place] for v in acc])
                for v, w in zip(acc, both, strict=True):
                    v[place] = w
                step *= 2
                place = place[place - step >= start[place]]
            if carry is not None and not first[0]:
                end = int(np.argmax(first)) if first.any() else n
                for v, w in zip(acc, _compose(carry, [v[:end] for v in acc]), strict=True):
                    v[:end] = w
            carry = [v[-1] for v in acc]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("user_id", "_blk", "_r", "event_id", "cur_total")]
                + [pa.array(v) for v in acc],
                names=["user_id", "_blk", "_r", "event_id", "cur_total", "ps", "pl", "ph"])
    return run


def _carry_scan(pdf: pd.DataFrame) -> pd.DataFrame:
    """State that the full blocks of one user leave to the next block, from
    their summaries (one row per full block)."""
    pdf = pdf.sort_values("_blk")
    x = 1
    ins = []
    for s, lo, hi in zip(pdf["bs"], pdf["bl"], pdf["bh"]):
        x = int(_apply((s, lo, hi), x))
        ins.append(x)
    return pd.DataFrame({"user_id": pdf["user_id"].to_numpy(),
                         "_blk": pdf["_blk"].to_numpy() + 1, "x_in": ins})


def page_replay(events: DataFrame, page_len: int = PAGE_LEN,
                block_rows: int = SQ.BLOCK_ROWS) -> DataFrame:
    """Page shown after each request: ``(event_id, page_no)``; null
    before the user's first query. Next/previous are clamped to
    [1, last page]; first page and a new query go to page 1."""
    act = _case(F.col("event_type"), PAGE_ACTION_OF_EVENT)
    e = events.select("event_id", "user_id", "ts", act.alias("act"),
                      F.when(act == "query", F.floor("value").cast("long")).alias("total"))
    # one sort-based ranking serves both the carry of the hit count and the blocks
    e = SQ.group_rank(e, ["user_id"], ["ts", "event_id"], "_r").drop("_gpos")
    e = SQ.fill_forward(e, ["user_id"], [], "total", "cur_total", block_rows, ranked="_r")
    last = F.greatest(F.ceil(F.col("cur_total") / page_len), F.lit(1)).cast("long")
    e = (e.withColumn("s", F.when(F.col("act") == "next", 1)
                      .when(F.col("act") == "prev", -1).otherwise(0).cast("long"))
         .withColumn("lo", F.when(F.col("act").isin("query", "first"), 1)
                     .when(F.col("act").isin("next", "prev"), 1).otherwise(-_BIG).cast("long"))
         .withColumn("hi", F.when(F.col("act").isin("query", "first"), 1)
                     .when(F.col("act").isin("next", "prev"), last).otherwise(_BIG).cast("long")))
    r = e.withColumn("_blk", F.floor((F.col("_r") - 1) / block_rows))
    local = (r.select("user_id", "_blk", "_r", "event_id", "cur_total", "s", "lo", "hi")
             .repartition("user_id", "_blk").sortWithinPartitions("user_id", "_blk", "_r")
             .mapInArrow(_scan(block_rows), SCANNED).checkpoint(eager=True))
    # only a full block has a next one; its summary is the prefix composition
    # at its last request
    summary = (local.where(F.col("_r") % block_rows == 0)
               .select("user_id", "_blk", F.col("ps").alias("bs"), F.col("pl").alias("bl"),
                       F.col("ph").alias("bh")))
    carry = summary.groupBy("user_id").applyInPandas(
        _carry_scan, "user_id long, _blk long, x_in long")
    out = (local.join(carry, ["user_id", "_blk"], "left")
           .withColumn("x_in", F.coalesce("x_in", F.lit(1))))
    page = F.least(F.col("ph"), F.greatest(F.col("pl"), F.col("x_in") + F.col("ps")))
    return out.select("event_id",
                      F.when(F.col("cur_total").isNotNull(), page).cast("int").alias("page_no"))


# ------------------------------------------------------- R3 as a stream ----

PAGE_STATE_SCHEMA = "page long, last long"
PAGE_OUT_SCHEMA = "event_id long, page_no int"


def _in_time_order(pdfs) -> pd.DataFrame:
    """A user's whole share of a micro-batch, which comes in Arrow-sized
    pieces of any order; its size is bounded by the trigger."""
    return pd.concat(list(pdfs), ignore_index=True).sort_values(["ts", "event_id"])


def _page_state_fn(key, pdfs, state):
    """Per user: apply each request of the micro-batch in time order to the
    kept (page, last page) state; emit the page shown after each request."""
    if state.exists:
        page, last = state.get
    else:
        page, last = None, None
    out_ids, out_pages = [], []
    pdf = _in_time_order(pdfs)
    for eid, typ, value in zip(pdf["event_id"], pdf["event_type"], pdf["value"]):
        act = PAGE_ACTION_OF_EVENT.get(typ, "none")
        if act == "query":
            page, last = 1, max(-(-int(value // 1) // PAGE_LEN), 1)
        elif page is not None and act == "first":
            page = 1
        elif page is not None and act == "next":
            page = min(page + 1, last)
        elif page is not None and act == "prev":
            page = max(page - 1, 1)
        out_ids.append(int(eid))
        out_pages.append(page)
    if page is not None:
        state.update((page, last))
    yield pd.DataFrame({"event_id": out_ids,
                        "page_no": pd.array(out_pages, dtype="Int32")})


def page_replay_stream(events: DataFrame) -> DataFrame:
    """R3 on a request stream: ``applyInPandasWithState`` keyed by user keeps
    (page, last page) between micro-batches (append mode). Within a
    micro-batch a user's requests are applied in time order; across batches
    the stream must deliver each user's requests in time order (as a log
    tail does)."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    return (events.select("user_id", "event_id", "ts", "event_type", "value")
            .groupBy("user_id")
            .applyInPandasWithState(_page_state_fn, PAGE_OUT_SCHEMA, PAGE_STATE_SCHEMA,
                                    "append", GroupStateTimeout.NoTimeout))


# ------------------------------------------------------- R1 as a stream ----

MODE_STATE_SCHEMA = "mode string"
MODE_OUT_SCHEMA = "event_id long, mode string"


def _mode_state_fn(key, pdfs, state):
    """Per user: the mode in force after each request of the micro-batch,
    carried between batches in the state (starts at 'both')."""
    mode = state.get[0] if state.exists else "both"
    out_ids, out_modes = [], []
    pdf = _in_time_order(pdfs)
    for eid, typ in zip(pdf["event_id"], pdf["event_type"]):
        new = MODE_OF_EVENT.get(typ)
        if new is not None:
            mode = new
        out_ids.append(int(eid))
        out_modes.append(mode)
    state.update((mode,))
    yield pd.DataFrame({"event_id": out_ids, "mode": out_modes})


def mode_replay_stream(events: DataFrame) -> DataFrame:
    """R1 on a request stream (``applyInPandasWithState`` keyed by user,
    append mode); each user's requests must arrive in time order across
    micro-batches."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    return (events.select("user_id", "event_id", "ts", "event_type")
            .groupBy("user_id")
            .applyInPandasWithState(_mode_state_fn, MODE_OUT_SCHEMA, MODE_STATE_SCHEMA,
                                    "append", GroupStateTimeout.NoTimeout))
