"""Sessions on a stream that come out once, when nothing can change them any more, and then leave the state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from beaconry.operators.sessions import KIND_RANK, STATUSES
from beaconry.streaming.buckets import BUCKETS, STATE, bucket, codes, firsts, gather, pack

_ROW = (
    "session_id STRING, release STRING, environment STRING, user_id STRING, platform STRING, started_ms BIGINT, "
    "ended_ms BIGINT, duration_ms BIGINT, status STRING, ended BOOLEAN"
)
_READ = ["seq", "kind", "at_ms", "final_status", "release", "environment", "user_id", "platform"]
_KINDS = [*KIND_RANK, "end"]
_EVENT = pa.schema([("session_id", pa.string()), *((c, pa.int64() if c in ("seq", "at_ms") else pa.string()) for c in _READ)])
_DUE = pa.schema([("session_id", pa.string()), ("due", pa.int64())])
STORE_MB = 100
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _table(state, schema: pa.Schema) -> pd.DataFrame:
    return gather([], schema, bytes(state.get()[0]) if state.exists() else None)


def _needed(events: pd.DataFrame) -> pd.DataFrame:
    """Of each session the earliest start, the first event of each kind behind it, and what lies ahead of it or has none."""
    events = events[events["kind"].isin(_KINDS) | (events["kind"] == "start")]
    of, kind, seq = codes(events["session_id"]), codes(events["kind"]), events["seq"].to_numpy("int64")
    start = (events["kind"] == "start").to_numpy(bool)
    starts = np.flatnonzero(start)
    starts = starts[firsts(of[starts], seq[starts])]
    begin = np.full(of.max(initial=-1) + 1, np.iinfo("int64").max)
    begin[of[starts]] = seq[starts]
    ahead = np.flatnonzero(~start & (seq <= begin[of]))
    behind = np.flatnonzero(~start & (seq > begin[of]))
    behind = behind[firsts(of[behind] * (len(_KINDS) + 1) + kind[behind], seq[behind])]
    return events.iloc[np.sort(np.r_[starts, ahead, behind])]


def _closed(events: pd.DataFrame) -> pd.DataFrame:
    """The rows of sessions that are over, from what is needed of them."""
    begin = events[events["kind"] == "start"].set_index("session_id")
    later = events[events["kind"] != "start"]
    later = later[later["session_id"].isin(begin.index)]
    later = later[later["seq"].to_numpy("int64") > begin["seq"].reindex(later["session_id"]).to_numpy("int64")]
    end = later[later["kind"] == "end"].set_index("session_id").reindex(begin.index)
    limit = end["seq"].fillna(np.iinfo("int64").max).reindex(later["session_id"]).to_numpy("int64")
    before = later[later["seq"].to_numpy("int64") < limit]
    rank = before["kind"].map(KIND_RANK).fillna(0).groupby(before["session_id"]).max().reindex(begin.index).fillna(0).astype(int)
    out = begin[["release", "environment", "user_id", "platform"]].assign(started_ms=begin["at_ms"], ended_ms=end["at_ms"])
    out["duration_ms"] = (out["ended_ms"] - out["started_ms"]).clip(lower=0)
    out["status"] = end["final_status"].where(end["final_status"].notna(), rank.map(dict(enumerate(STATUSES))))
    return out.assign(ended=end["seq"].notna().astype(bool)).reset_index()[[c.split()[0] for c in _ROW.split(", ")]]


class SessionCloser(StatefulProcessor):
    """The state of a bucket of sessions: of each its earliest start, the first event of each kind behind it, and the
    events that came before any start or lie ahead of it, for as long as an earlier start may still arrive.

    Events may arrive in any order; ``seq`` is theirs. A session is due ``idle_ms`` behind its last event, and a timer
    stands where the first of a bucket is due. When the watermark passes it, all sessions that are due come out, if
    they have a start, and all of their state goes.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getValueState("events", STATE)
        self.due = handle.getValueState("due", STATE)
        self.timer = handle.getValueState("timer", "at_ms BIGINT")

    def _keep(self, events: pd.DataFrame, due: pd.DataFrame, old: int | None) -> None:
        if len(events):
            self.events.update((pack(events, _EVENT),))
        else:
            self.events.clear()
        first = int(due["due"].min()) if len(due) else None
        if len(due):
            self.due.update((pack(due, _DUE),))
        else:
            self.due.clear()
        if first == old:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if first is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(first)
            self.timer.update((first,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events, due = _table(self.events, _EVENT), _table(self.due, _DUE)
        for batch in rows:
            new = gather([batch], _EVENT)
            due = pd.concat([due, new[["session_id"]].assign(due=new["at_ms"] + self.idle_ms)], ignore_index=True)
            due = due.iloc[firsts(codes(due["session_id"]), -due["due"].to_numpy("int64"))]
            events = _needed(pd.concat([events, new], ignore_index=True))
        self._keep(events, due, self.timer.get()[0] if self.timer.exists() else None)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events, due = _table(self.events, _EVENT), _table(self.due, _DUE)
        over = (due["due"] <= max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())).to_numpy(bool)
        gone = events["session_id"].isin(due["session_id"][over]).to_numpy(bool)
        # The timer that has expired is gone by itself.
        self._keep(events[~gone], due[~over], None)
        if over.all():
            self.timer.clear()
        closed = _closed(events[gone])
        yield closed if len(closed) else pd.DataFrame()

    def close(self) -> None:
        pass


def keep_state_in_files(spark: SparkSession) -> None:
    """New streams of the session keep their state in RocksDB, which timers and states of several kinds ask for.

    The stores of an executor share one bound of memory beside the heap.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(STORE_MB))


def close_sessions(session_events: DataFrame, delay: str = "10 minutes", idle_ms: int = 1_800_000, buckets: int = BUCKETS) -> DataFrame:
    """Each session once, as :func:`~beaconry.operators.sessions.fold_sessions` has it, when it is over.

    Events may come in any order, also over micro-batches, at most ``delay`` late by ``at_ms``. A session is over
    when the watermark has passed its last event by ``idle_ms``; its state is then gone, and a later event with its
    id begins another. Events without a session, a sequence number or a time take no part, but their time moves the
    watermark; a session without a start gives no row. Beside first events the state of a session holds what came
    ahead of its start. Sessions are held in ``buckets`` (see :mod:`~beaconry.streaming.buckets`).
    """
    keep_state_in_files(session_events.sparkSession)
    timed = session_events.withColumn("_at", F.timestamp_millis("at_ms")).withWatermark("_at", delay)
    # One condition on the clock as well, or the optimizer drops events ahead of the watermark that they should move.
    known = F.when(F.col("_at").isNotNull(), F.col("session_id").isNotNull() & F.col("seq").isNotNull())
    events = timed.where(known).select(bucket("session_id", buckets).alias("_bucket"), "session_id", *_READ, "_at")
    return events.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=SessionCloser(idle_ms), outputStructType=_ROW, outputMode="append", timeMode="eventTime"
    )
