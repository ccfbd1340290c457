"""Stateful streams: request joins, call pairing, session folding, statement statistics.

Stateless operators (context, sampling, redaction, scrubbing, projections) run on streams as they
are. Time columns are taken from the epoch-millisecond columns; rows whose partner does not come in
time are the output of operators of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from beaconry.functions import sqltext, url
from beaconry.functions.privacy import Extras
from beaconry.operators.outbound import CALL_FIELDS, COMPLETIONS, call_context, call_target, finished_calls, heard_events
from beaconry.operators.requests import request_row
from beaconry.operators.sampling import exclude_ingest_host
from beaconry.operators.sessions import KIND_RANK, STATUSES
from beaconry.settings import Settings
from beaconry.streaming.buckets import BUCKETS, STATE, Packed, bucket, codes, firsts, gather, pack, parted, unpacked
from beaconry.streaming.closing import keep_state_in_files


def _requests(ctx: DataFrame, ends: DataFrame, delay: str, within: str | None, how: str) -> DataFrame:
    left = ctx.where("sampled").withColumn("_at", F.timestamp_millis("started_ms")).withWatermark("_at", delay)
    right = (
        ends.withColumn("_end", F.timestamp_millis("ended_ms")).withColumnRenamed("request_key", "_key")
        .withWatermark("_end", delay)
    )
    # The end may carry an earlier clock than the start; the bound holds in both directions.
    bound = F.expr(f"INTERVAL {within or delay}")
    near = F.col("_end").between(F.col("_at") - bound, F.col("_at") + bound)
    return left.join(right, (F.col("request_key") == F.col("_key")) & near, how)


def stream_http_rows(
    ctx: DataFrame, ends: DataFrame, settings: Settings = Settings(), delay: str = "10 minutes",
    capture_headers: bool = False, extra: Extras = (), within: str | None = None,
) -> DataFrame:
    """Request rows from a stream of starts (with context) and a stream of ends.

    ``delay`` is how late rows may arrive, ``within`` (default: the delay) how far apart start and end may be.
    What finds no partner comes out of :func:`stream_unfinished_requests` and :func:`stream_stray_ends`.
    """
    return request_row(_requests(ctx, ends, delay, within, "inner"), settings, capture_headers, extra, False)


def stream_unfinished_requests(ctx: DataFrame, ends: DataFrame, delay: str = "10 minutes", within: str | None = None) -> DataFrame:
    """The sampled starts that no end within the bound follows, once the watermark has passed it."""
    joined = _requests(ctx, ends, delay, within, "left")
    return joined.where(F.col("_key").isNull()).select(*ctx.columns)


def stream_stray_ends(ctx: DataFrame, ends: DataFrame, delay: str = "10 minutes", within: str | None = None) -> DataFrame:
    """The ends without a sampled start within the bound, once the watermark has passed it."""
    joined = _requests(ctx, ends, delay, within, "right")
    return joined.where(F.col("_at").isNull()).select(F.col("_key").alias("request_key"), *[c for c in ends.columns if c != "request_key"])


class _CallBuckets(StatefulProcessor):
    """Buckets of call keys, each worked on by parts of its keys.

    ``part_of`` takes what the state holds of some keys, a table for each of the schemas, their new events and the
    watermark. It gives the tables to hold on, when the watermark next changes something in them, and calls or None.
    The state of a bucket has a row for each part: the tables, packed, and in the first one the time of the bucket's
    timer and the number of parts.
    """

    def __init__(self, schemas: Sequence[pa.Schema], part_of: Callable[..., tuple[tuple[pd.DataFrame, ...], int, pd.DataFrame | None]]):
        self.schemas, self.part_of = schemas, part_of

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        tables = ", ".join(f"held{i} BINARY" for i in range(len(self.schemas)))
        self.state = handle.getMapState("calls", "part INT", f"{tables}, timer BIGINT, parts INT")

    def _held(self, of: int, parts: int) -> Iterator[pd.DataFrame]:
        for p in range(parts):
            yield from unpacked(self.state.getValue((p,))[of])

    def _advance(self, batches: Iterator[pd.DataFrame], mark: int, expired: bool) -> Iterator[pd.DataFrame]:
        timer, parts = (self.state.getValue((0,)) if self.state.containsKey((0,)) else (None, 0))[-2:]
        due, rows, first = _NEVER, 0, None
        sources = [*((schema, self._held(i, parts)) for i, schema in enumerate(self.schemas)), (self.schemas[0], batches)]
        # What is held has been read when the first part is given.
        for tables in parted(sources, "call_key"):
            kept, soon, calls = self.part_of(*tables, mark)
            due = min(due, soon)
            yield pd.DataFrame() if calls is None else calls
            if any(map(len, kept)):
                row = []
                for schema, table in zip(self.schemas, kept, strict=True):
                    packed = Packed(schema)
                    packed.add(table)
                    row.append(packed.value())
                if rows:
                    self.state.updateValue((rows,), (*row, None, None))
                else:
                    first = row
                rows += 1
        for p in range(rows, parts):
            self.state.removeKey((p,))
        if timer is not None and not expired:
            self.handle.deleteTimer(timer)
        if rows:
            timer = max(mark + 1, due)
            self.state.updateValue((0,), (*first, timer, rows))
            self.handle.registerTimer(timer)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._advance(rows, timerValues.getCurrentWatermarkInMs(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(iter(()), timerValues.getCurrentWatermarkInMs(), True)

    def close(self) -> None:
        pass


_PAYLOAD = ("origin", "path", "method", "trace_id", "parent_span_id", "request_id")
# Kinds of call events as numbers; 0 is a creation.
_KINDS = ["create", *COMPLETIONS]
_EVENT_NUMBERS = ("at_ms", "until", "free", "kind", "status_code")
_CALL_EVENT = pa.schema([("call_key", pa.string()), *((c, pa.int64()) for c in _EVENT_NUMBERS), *((c, pa.string()) for c in _PAYLOAD)])
_CALL_DONE = pa.schema([("call_key", pa.string()), ("free", pa.int64())])
_NEVER = np.iinfo("int64").max
_FIRST_OUT = f"call_key STRING, at_ms BIGINT, {', '.join(f'{c} STRING' for c in _PAYLOAD)}, after_kind BIGINT, after_at BIGINT, after_code BIGINT"


def _beside(of: np.ndarray, at: np.ndarray, until: np.ndarray, create: np.ndarray, end: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of creations and of ends of their key in time: of each creation the next end, or (``back``) of each end the creation before it."""
    places = np.flatnonzero(create | end)
    places = places[np.lexsort((end[places], at[places], of[places]))]
    begins, row = create[places], np.arange(len(places))
    if back:
        beside = np.maximum.accumulate(np.where(begins, row, -1))
        row = np.flatnonzero(~begins & (beside >= 0))
        starts, ends = places[beside[row]], places[row]
    else:
        beside = np.minimum.accumulate(np.where(begins, len(row), row)[::-1])[::-1]
        row = np.flatnonzero(begins & (beside < len(beside)))
        starts, ends = places[row], places[beside[row]]
    near = (of[starts] == of[ends]) & (at[ends] <= until[starts])
    return starts[near], ends[near]


def _first_calls(finished: bool):
    """Pair the call events of a bucket of keys as they come: finished calls, or the creations that nothing has ended in time.

    The state holds the events that a later one may still be paired with and, for finished calls, the keys that
    have given one, until ``free``: to the watermark, what a key can have had before then is all gone.
    """

    def part_of(known: pd.DataFrame, done: pd.DataFrame, come: pd.DataFrame, mark: int) -> tuple[tuple[pd.DataFrame, ...], int, pd.DataFrame | None]:
        # In order of arrival, inside a micro-batch of time.
        events = pd.concat([known, come.sort_values("at_ms", kind="stable")], ignore_index=True)
        new = np.arange(len(events)) >= len(known)
        of = codes(pd.concat([events["call_key"], done["call_key"]], ignore_index=True))
        of, over = of[: len(events)], of[len(events) :]
        at, until, free, kind, _ = (events[c].to_numpy("int64") for c in _EVENT_NUMBERS)
        create = kind == 0
        # Ends that came in an earlier micro-batch, then those of this one.
        turns = ((create & new, ~create & ~new), (create, ~create & new))
        starts, ends = map(np.concatenate, zip(*(_beside(of, at, until, *turn, finished) for turn in turns), strict=True))
        if finished:
            ends = ends[~np.isin(of[ends], over)]
            ends = ends[firsts(of[ends], ends)]
            chosen = np.full(max(of.max(initial=-1), over.max(initial=-1)) + 1, -1)
            chosen[of[ends]] = ends
            end = chosen[of]
            starts = np.flatnonzero(create & (end >= 0) & (at <= at[end]) & (at[end] <= until) & (new | new[end])) if len(ends) else ends
            starts = starts[firsts(of[starts], starts)]
            ends = end[starts]
            done = pd.concat([done, events.iloc[starts][["call_key", "free"]]], ignore_index=True)
            over, frees = np.r_[over, of[starts]], done["free"].to_numpy("int64")
            floor = np.full(len(chosen), mark)
            np.maximum.at(floor, over, frees)
            keep, done = np.where(create, until, at) > floor[of], done[frees > mark]
        else:
            waits = create.copy()
            waits[starts] = False
            starts = np.flatnonzero(waits & (until < mark))
            keep = np.where(create, waits & (until >= mark), at > mark)
        due = np.r_[np.where(create, until, at)[keep], done["free"].to_numpy("int64") - 1]
        calls = None
        if len(starts):
            calls = events.iloc[starts][["call_key", "at_ms", *_PAYLOAD]].reset_index(drop=True)
            calls = calls.assign(**{f"after_{c}": x[ends] if finished else 0 for c, x in (("kind", kind), ("at", at), ("code", events["status_code"].to_numpy("int64")))})
        return (events[keep], done), int(due.min(initial=_NEVER)), calls

    return part_of


def _first_paired(call_events: DataFrame, ingest_host: str, delay: str, within: str | None, buckets: int, finished: bool) -> DataFrame:
    keep_state_in_files(call_events.sparkSession)
    creates = call_events.where((F.col("kind") == "create") & F.coalesce("sampled", F.lit(True)))
    if ingest_host:
        creates = exclude_ingest_host(creates.withColumn("host", url.parse_origin(F.col("origin"))["host"]), ingest_host)
    ends = call_events.where(F.col("kind").isin(COMPLETIONS)).withColumns({c: F.lit(None).cast("string") for c in _PAYLOAD})

    def timed(events: DataFrame) -> DataFrame:
        """Creations and ends move a watermark each; the earlier one counts."""
        kind = F.array_position(F.array(*map(F.lit, _KINDS)), F.col("kind")) - 1
        return (
            events.withColumn("_at", F.timestamp_millis("at_ms")).withWatermark("_at", delay)
            .select("call_key", F.col("at_ms").cast("bigint"), kind.alias("kind"), F.coalesce(F.col("status_code").cast("bigint"), F.lit(0)).alias("status_code"), *_PAYLOAD, "_at")
        )

    creates, ends = timed(creates), timed(ends).where(F.col("call_key").isNotNull())
    if finished:
        creates = creates.where(F.col("call_key").isNotNull())
    # One condition on the clock; events without one are paired with nothing.
    events = creates.unionByName(ends).where(F.col("_at").isNotNull())
    until = F.col("_at") + F.expr(f"INTERVAL {within or delay}")
    events = events.withColumns({"until": F.unix_millis(until), "free": F.unix_millis(until + F.expr(f"INTERVAL {delay}")), "_bucket": bucket("call_key", buckets)})
    return events.groupBy("_bucket").transformWithStateInPandas(
        _CallBuckets((_CALL_EVENT, _CALL_DONE), _first_calls(finished)), outputStructType=_FIRST_OUT, outputMode="append", timeMode="eventTime"
    )


def stream_paired_calls(
    call_events: DataFrame, ingest_host: str = "", delay: str = "10 minutes", within: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Finished calls from a stream of call events with one creation per call key.

    Of several completions of one call the stream keeps the one that arrives first, of those in one micro-batch the
    earliest. ``delay`` and ``within`` as in :func:`stream_http_rows`; creations without a completion come out of
    :func:`stream_open_calls`. The calls are held in ``buckets`` of keys (see :mod:`~beaconry.streaming.buckets`).
    """
    calls = _first_paired(call_events, ingest_host, delay, within, buckets, True)
    kind = F.get(F.array(*map(F.lit, _KINDS)), F.col("after_kind").cast("int"))
    after = F.struct(kind.alias("kind"), F.col("after_at").alias("at_ms"), F.col("after_code").cast("int").alias("status_code"))
    return finished_calls(calls.withColumns({"_after": after, "sampled": F.lit(True)}))


def stream_open_calls(
    call_events: DataFrame, ingest_host: str = "", delay: str = "10 minutes", within: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The creations that no completion within the bound follows, once the watermark has passed it."""
    calls = _first_paired(call_events, ingest_host, delay, within, buckets, False)
    return call_target(call_context(calls.withColumn("sampled", F.lit(True)))).select(
        "call_key", F.col("at_ms").alias("started_ms"), "trace_id", "parent_span_id", "request_id", "span_id", "method", "host", "port", "path"
    )


_CALL_KINDS = {"at_ms": "BIGINT", "sampled": "BOOLEAN", "status_code": "INT"}
_CALL_TYPES = [_CALL_KINDS.get(c, "STRING") for c in CALL_FIELDS]
_CALL_ROW = ", ".join(f"{c} {t}" for c, t in zip(CALL_FIELDS, _CALL_TYPES, strict=True))
_CALL_OUT = f"call_key STRING, {_CALL_ROW}, after_kind STRING, after_at BIGINT, after_code INT"
_ARROW = {"BIGINT": pa.int64(), "INT": pa.int32(), "BOOLEAN": pa.bool_(), "STRING": pa.string()}


def _pair_calls(within_ms: int, ranks: int):
    """Pair the events of a bucket of call keys that the watermark has passed.

    The state holds the events not passed yet, and of each key the last passed one while it is a creation that may
    still be ended.
    """
    order = [f"rank{i}" for i in range(ranks)]
    kinds = [("call_key", pa.string()), *((c, pa.int64()) for c in order), *((c, _ARROW[t]) for c, t in zip(CALL_FIELDS, _CALL_TYPES, strict=True))]
    schema = pa.schema(kinds)

    def part_of(known: pd.DataFrame, come: pd.DataFrame, mark: int) -> tuple[tuple[pd.DataFrame, ...], int, pd.DataFrame | None]:
        events = pd.concat([known, come], ignore_index=True)
        at, call = events["at_ms"].to_numpy("int64"), codes(events["call_key"])
        places = np.lexsort((*(events[c].to_numpy("int64") for c in reversed(order)), at, call))
        events, at, call = events.take(places), at[places], call[places]
        create = (events["kind"] == "create").to_numpy(bool)
        done = events["kind"].isin(COMPLETIONS).to_numpy(bool)
        passed = at < mark
        same = call[1:] == call[:-1]
        ends = np.flatnonzero(same & create[:-1] & done[1:] & passed[1:] & (at[1:] - at[:-1] <= within_ms))
        last = passed & np.r_[~(same & passed[1:]), np.ones(len(at[:1]), bool)]
        still = last & create & (at + within_ms >= mark)
        due, calls = np.r_[at[~passed], at[still] + within_ms], None
        if len(ends):
            calls, after = events.iloc[ends].drop(columns=order).reset_index(drop=True), events.iloc[ends + 1]
            calls = calls.assign(after_kind=after["kind"].array, after_at=after["at_ms"].array, after_code=after["status_code"].array)
        return (events[still | ~passed],), int(due.min(initial=_NEVER)), calls

    return schema, part_of


def stream_reused_calls(
    call_events: DataFrame, ingest_host: str = "", delay: str = "10 minutes", within_ms: int = 600_000, order: tuple[str, ...] = ("at_ms", "seq"),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Finished calls from a stream whose call keys may come again, paired as the batch form pairs them.

    Events wait until the watermark passes them (``delay`` is how late they may arrive) and are then taken in
    event order, so the arrival order does not show. ``within_ms`` is how long a call may take; a completion
    later than that ends nothing. ``order`` columns beside ``at_ms`` are whole numbers. The state of a key is what
    arrived within the delay, held in ``buckets`` of keys (see :mod:`~beaconry.streaming.buckets`). :func:`stream_paired_calls` gives a call out
    at once where a key is created once.
    """
    ranks = [F.coalesce(F.col(c).cast("bigint"), F.lit(-(2**63))).alias(f"rank{i}") for i, c in enumerate(c for c in order if c != "at_ms")]
    keep_state_in_files(call_events.sparkSession)
    heard = heard_events(call_events, ingest_host).where(F.col("at_ms").isNotNull())
    # A call has the payload of its creation.
    heard = heard.withColumns({c: F.when(F.col("kind") == "create", F.col(c)) for c in _PAYLOAD})
    events = heard.select("call_key", *ranks, *[F.col(c).cast(t) for c, t in zip(CALL_FIELDS, _CALL_TYPES, strict=True)])
    timed = events.withColumn("_at", F.timestamp_millis("at_ms")).withWatermark("_at", delay)
    schema, part_of = _pair_calls(within_ms, len(ranks))
    calls = timed.withColumn("_bucket", bucket("call_key", buckets)).groupBy("_bucket").transformWithStateInPandas(
        _CallBuckets((schema,), part_of), outputStructType=_CALL_OUT, outputMode="append", timeMode="eventTime"
    )
    after = F.struct(F.col("after_kind").alias("kind"), F.col("after_at").alias("at_ms"), F.col("after_code").alias("status_code"))
    return finished_calls(calls.withColumn("_after", after))


_SESSION_OUT = (
    "session_id STRING, release STRING, environment STRING, user_id STRING, started_ms BIGINT, ended_ms BIGINT, "
    "duration_ms BIGINT, status STRING, ended BOOLEAN"
)
_SESSION_READ = ["seq", "kind", "at_ms", "final_status", "release", "environment", "user_id"]
_SESSION_EVENT = pa.schema([("session_id", pa.string()), *((c, pa.int64() if c in ("seq", "at_ms") else pa.string()) for c in _SESSION_READ)])
_SESSION_STATE = pa.schema([
    ("session_id", pa.string()), ("seq", pa.int64()), ("at_ms", pa.int64()), ("release", pa.string()), ("environment", pa.string()),
    ("user_id", pa.string()), ("rank", pa.int64()), ("ended", pa.bool_()),
])


def _fold(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Advance the sessions of a bucket by one micro-batch. The state of a session is seven scalars."""
    known = gather([], _SESSION_STATE, state.get[0] if state.exists else None)
    events = gather(batches, _SESSION_EVENT)
    events = events[events["seq"].notna()]
    of = codes(pd.concat([known["session_id"], events["session_id"]], ignore_index=True))
    begun, of = of[: len(known)], of[len(known) :]
    # One row per session, by its code: those of the state, then what starts in this micro-batch.
    seq, kind = events["seq"].to_numpy("int64"), events["kind"].to_numpy(object)
    new = np.flatnonzero((kind == "start") & ~np.isin(of, begun))
    new = new[firsts(of[new], seq[new])]
    began = events.iloc[new][["session_id", "seq", "at_ms", "release", "environment", "user_id"]].assign(rank=0, ended=False)
    began = began.astype({"rank": "Int64", "ended": "boolean"})
    sessions = pd.concat([known, began], ignore_index=True) if len(known) else began.reset_index(drop=True)
    if not len(sessions):
        return
    place = np.full(max(begun.max(initial=-1), of.max(initial=-1)) + 1, -1)
    place[np.r_[begun, of[new]]] = np.arange(len(sessions))
    at = place[of]
    ended = sessions["ended"].to_numpy(bool)
    open_ = (at >= 0) & ~ended[at]
    touched = np.unique(at[open_])
    if not len(touched):
        return
    behind = open_ & (seq > sessions["seq"].to_numpy("int64")[at])
    ends = np.flatnonzero(behind & (kind == "end"))
    ends = ends[firsts(at[ends], seq[ends])]
    limit = np.full(len(sessions), np.iinfo("int64").max)
    limit[at[ends]] = seq[ends]
    ranks = events["kind"].map(KIND_RANK).fillna(0).to_numpy("int64")
    within = behind & (seq < limit[at])
    rank = sessions["rank"].to_numpy("int64").copy()
    np.maximum.at(rank, at[within], ranks[within])
    ended = ended.copy()
    ended[at[ends]] = True
    sessions["rank"], sessions["ended"] = pd.array(rank, "Int64"), pd.array(ended, "boolean")
    state.update((pack(sessions, _SESSION_STATE),))
    end = events.iloc[ends].assign(_at=at[ends]).set_index("_at")
    out = sessions.loc[touched, ["session_id", "release", "environment", "user_id", "ended"]].assign(started_ms=sessions["at_ms"])
    out["ended_ms"] = end["at_ms"].reindex(touched)
    took = (out["ended_ms"] - out["started_ms"]).fillna(0).clip(lower=0)
    out["duration_ms"] = took.where(out["ended"].astype(bool))
    status = pd.Series([STATUSES[r] for r in rank[touched]], index=touched, dtype=object)
    final = end["final_status"].reindex(touched)
    out["status"] = final.where(final.notna(), status)
    yield out[_SESSION_NAMES].astype({"ended": bool})


_SESSION_NAMES = [c.split()[0] for c in _SESSION_OUT.split(", ")]


def stream_sessions(session_events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Current state of each session touched by a micro-batch (update mode).

    Within a session the micro-batches must follow the event order; inside one, any order will do. The sessions are
    held in ``buckets`` (see :mod:`~beaconry.streaming.buckets`).
    """
    events = session_events.select(bucket("session_id", buckets).alias("_bucket"), "session_id", *_SESSION_READ)
    return events.groupBy("_bucket").applyInPandasWithState(
        _fold, _SESSION_OUT, STATE, "update", GroupStateTimeout.NoTimeout
    )


def stream_fingerprint_stats(db_queries: DataFrame, window: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Statement statistics per event-time window; percentiles are approximate here."""
    at = F.timestamp_millis("timestamp_millis")
    stats = (
        db_queries.withColumn("_at", at).withWatermark("_at", delay)
        .groupBy(F.window("_at", window), "normalized_query", "query_type", "database_type")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.count_if(F.col("status") == "error").alias("errors"),
            F.percentile_approx("duration_ms", [0.5, 0.95]).alias("p"),
            F.max("duration_ms").alias("max_ms"),
            F.sum("duration_ms").alias("total_ms"),
        )
    )
    return stats.select(
        F.col("window.start").alias("window_start"), "normalized_query",
        sqltext.text_hash(F.col("normalized_query")).alias("query_hash"), "query_type", "database_type",
        "calls", "errors", F.get("p", F.lit(0)).alias("p50_ms"), F.get("p", F.lit(1)).alias("p95_ms"), "max_ms", "total_ms",
    )
