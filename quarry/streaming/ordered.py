"""Per-user replays (R1, R3) of a request stream whose rows come out of order.

``transformWithStateInPandas`` keeps two things per user: the state of the walk
(page and last page, or the mode) and a buffer of the requests that the
watermark has not passed. When it passes the earliest of them an event-time
timer fires, and the requests up to the watermark are applied in the order of
(ts, event_id). So any batches give the rows that the whole log would give, as
long as a request is not later than the watermark's delay; later ones are left
out, as Spark does. The buffer of a user holds what the user sent within the
delay. State lies in RocksDB (``spark.sql.streaming.stateStore.providerClass``),
so it may outgrow memory, and is checkpointed with the query.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor

from quarry.functions.constants import PAGE_LEN
from quarry.streaming.replay import MODE_OF_EVENT, PAGE_ACTION_OF_EVENT

REQUEST = "event_id long, ts_ms long, event_type string, value double"


class OrderedReplay(StatefulProcessor):
    """Buffers a user's requests and applies them in order with ``apply``;
    ``STATE`` and ``OUT`` are the schemas of the state and of a result."""

    STATE: str
    OUT: str

    def apply(self, state: tuple | None, event_type: str, value: float | None) -> tuple[tuple | None, object]:
        """(new state, result) of one request."""
        raise NotImplementedError

    def init(self, handle) -> None:
        self.handle = handle
        self.walk = handle.getValueState("walk", self.STATE)
        self.buffer = handle.getListState("buffer", REQUEST)

    def handleInputRows(self, key, rows, timerValues):
        new = []
        for pdf in rows:
            ms = pdf["ts"].astype("datetime64[ms]").astype("int64")
            value = pdf["value"].astype(object).where(pdf["value"].notna(), None)
            new += list(zip(pdf["event_id"].tolist(), ms.tolist(), pdf["event_type"].tolist(), value.tolist(),
                            strict=True))
        if new:
            self.buffer.appendList(new)
            self._wake(min(r[1] for r in new))
        return iter([])

    def _wake(self, ms: int) -> None:
        """One timer, at the earliest request that waits."""
        timers = list(self.handle.listTimers())
        if timers and min(timers) <= ms + 1:
            return
        for t in timers:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(ms + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        waiting = sorted((tuple(r) for r in self.buffer.get()), key=lambda r: (r[1], r[0]))
        ready = [r for r in waiting if r[1] < mark]
        rest = waiting[len(ready):]
        state = tuple(self.walk.get()) if self.walk.exists() else None
        out = []
        for event_id, _, event_type, value in ready:
            state, shown = self.apply(state, event_type, value)
            out.append((event_id, shown))
        if state is not None:
            self.walk.update(state)
        if rest:
            self.buffer.put(rest)
            self.handle.registerTimer(rest[0][1] + 1)
        else:
            self.buffer.clear()
        ids, shown = zip(*out, strict=True) if out else ((), ())
        yield self.frame(list(ids), list(shown))

    def frame(self, ids: list, shown: list) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


class PageWalk(OrderedReplay):
    """Page and last page of the user's query."""

    STATE = "page long, last long"
    OUT = "event_id long, page_no int"

    def apply(self, state, event_type, value):
        act = PAGE_ACTION_OF_EVENT.get(event_type)
        if act == "query" and value is not None:
            return (1, max(-(-int(value // 1) // PAGE_LEN), 1)), 1
        if state is None:
            return None, None
        page, last = state
        page = {"next": min(page + 1, last), "prev": max(page - 1, 1), "first": 1, "query": 1}.get(act, page)
        return (page, last), page

    def frame(self, ids, shown):
        return pd.DataFrame({"event_id": pd.Series(ids, dtype="int64"), "page_no": pd.array(shown, dtype="Int32")})


class ModeWalk(OrderedReplay):
    """The scoring mode in force, "both" at first."""

    STATE = "mode string"
    OUT = "event_id long, mode string"

    def apply(self, state, event_type, value):
        mode = MODE_OF_EVENT.get(event_type) or (state[0] if state else "both")
        return (mode,), mode

    def frame(self, ids, shown):
        return pd.DataFrame({"event_id": pd.Series(ids, dtype="int64"), "mode": pd.Series(shown, dtype="object")})


def ordered_replay(events: DataFrame, walk: OrderedReplay, delay: str) -> DataFrame:
    """Requests ``(user_id, event_id, ts, event_type, value)`` as a stream →
    the results of ``walk``, once the watermark (``delay`` behind the latest
    request) has passed them."""
    return (events.select("user_id", "event_id", "ts", "event_type", "value")
            .withWatermark("ts", delay).groupBy("user_id")
            .transformWithStateInPandas(walk, walk.OUT, "append", "eventTime"))
