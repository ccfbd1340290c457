"""Session folding and release health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions.clock import DAY_MS
from beaconry.operators.skew import match_one
from beaconry.settings import Settings

# Statuses by rank, and the event kinds that lead to them.
STATUSES = ["ok", "errored", "abnormal", "crashed"]
KIND_RANK = {"error": 1, "abnormal": 2, "crash": 3}


def status_rank(status: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STATUSES)), status) - 1


def status_name(rank: Column) -> Column:
    return F.get(F.array(*map(F.lit, STATUSES)), rank.cast("int"))


def fold_sessions(session_events: DataFrame) -> DataFrame:
    """Final state per session: first start, first end after it, worst status strictly between.

    The earliest event of each kind after the start says whether that kind fell before the end, so
    no per-session list is kept and partial results merge.
    """
    first = lambda cond, *what: F.min(F.when(cond, F.struct("seq", *what)))
    kind, seq, begin = F.col("kind"), F.col("seq"), F.col("_from")
    begun = session_events.where(kind == "start").groupBy("session_id").agg(F.min("seq").alias("_from"))
    events = match_one(session_events, begun, ["session_id"], ["seq"])
    folded = (
        events.where(seq >= begin)
        .groupBy("session_id")
        .agg(
            first(seq == begin, "at_ms", "release", "environment", "user_id", "platform").alias("start"),
            first((kind == "end") & (seq > begin), "at_ms", "final_status").alias("end"),
            *[F.min(F.when((kind == k) & (seq > begin), seq)).alias(f"first_{k}") for k in KIND_RANK],
        )
    )
    end = F.col("end")
    rank = F.greatest(
        F.lit(0),
        *[
            F.when(F.col(f"first_{k}").isNotNull() & (end.isNull() | (F.col(f"first_{k}") < end["seq"])), r).otherwise(0)
            for k, r in KIND_RANK.items()
        ],
    )
    return folded.select(
        "session_id",
        F.col("start.release").alias("release"),
        F.col("start.environment").alias("environment"),
        F.col("start.user_id").alias("user_id"),
        F.col("start.platform").alias("platform"),
        F.col("start.at_ms").alias("started_ms"),
        end["at_ms"].alias("ended_ms"),
        F.when(end.isNotNull(), F.greatest(end["at_ms"] - F.col("start.at_ms"), F.lit(0))).alias("duration_ms"),
        F.coalesce(end["final_status"], status_name(rank)).alias("status"),
        end.isNotNull().alias("ended"),
    )


def compact_session_events(session_events: DataFrame) -> DataFrame:
    """At most nine events per session that fold to the same result as all of them.

    Kept are the first start and the first event of each other kind before and after it. Compacting
    the parts of a log one by one and folding the union gives the fold of the whole log, as long as
    each part holds later events than the parts before.
    """
    kind = F.col("kind")
    starts = session_events.groupBy("session_id").agg(F.min(F.when(kind == "start", F.col("seq"))).alias("_from"))
    marked = match_one(session_events, starts, ["session_id"], ["seq"])
    before = F.coalesce(F.col("seq") < F.col("_from"), F.lit(True))
    names = [c for c in session_events.columns if c not in ("session_id", "kind", "seq")]
    return (
        marked.groupBy("session_id", "kind", before.alias("_before"))
        .agg(F.min(F.struct("seq", *names)).alias("_first"))
        .select("session_id", "kind", "_first.*")
        .select(*session_events.columns)
    )


def build_session_rows(session_events: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Start and end rows; sessions without a release emit nothing."""
    folded = fold_sessions(session_events).where(F.coalesce("release", F.lit("")) != "")
    starts = folded.select(
        "session_id", "release", "environment", "user_id",
        F.lit(settings.sdk_name).alias("sdk_name"), F.lit(settings.sdk_version).alias("sdk_version"), "platform",
    )
    ends = folded.where("ended").select("session_id", "duration_ms", "status")
    return starts, ends


def crash_free_rates(
    session_ends: DataFrame, session_starts: DataFrame, by: tuple[str, ...] = ("release", "environment"), totals: bool = False
) -> DataFrame:
    """:func:`session_rates` of start and end rows that were delivered apart."""
    rows = session_starts.join(session_ends.select("session_id", "status"), "session_id", "left")
    return session_rates(rows, by, totals)


def session_rates(
    sessions: DataFrame, by: tuple[str, ...] = ("release", "environment"), totals: bool = False, users_error: float = 0.0
) -> DataFrame:
    """Sessions, crashed sessions and users and their crash-free shares per group.

    ``sessions`` has a status per session, NULL while it is open; the folded table will do as it is. ``day`` in
    ``by`` is the UTC day of ``started_ms``. Sessions are first counted per (group, user), which makes the distinct
    users plain counts. With ``totals`` the groups are rolled up too. With ``users_error`` above 0 users are
    estimated within that relative error, with no row per user; there are no totals then.
    """
    rows = sessions
    if "day" in by and "day" not in rows.columns:
        rows = rows.withColumn("day", F.date_from_unix_date(F.floor(F.col("started_ms") / DAY_MS).cast("int")))
    if "ended" in rows.columns:
        rows = rows.withColumn("status", F.when(F.col("ended"), F.col("status")))
    crashed = F.coalesce(F.col("status") == "crashed", F.lit(False))
    if users_error > 0:
        if totals:
            raise ValueError("estimated users have no totals")
        estimate = lambda c: F.approx_count_distinct(c, users_error)
        return _shares(
            rows.groupBy(*by).agg(
                F.count(F.lit(1)).alias("sessions"), F.count_if(crashed).alias("crashed_sessions"),
                estimate("user_id").alias("users"), estimate(F.when(crashed, F.col("user_id"))).alias("crashed_users"),
            )
        )
    per_user = rows.groupBy(*by, "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(crashed).alias("c")
    )
    if not totals:
        return _shares(per_user.groupBy(*by).agg(*_rates()))
    # A user seen in several groups counts once in each total, so every level regroups by user.
    levels = F.array(
        *[
            F.struct(F.lit(depth).alias("_level"), *[(F.col(n) if i < depth else F.lit(None).cast(rows.schema[n].dataType)).alias(n) for i, n in enumerate(by)])
            for depth in range(len(by) + 1)
        ]
    )
    spread = per_user.select(F.inline(levels), "user_id", "n", "c")
    keys = ["_level", *by]
    once = spread.groupBy(*keys, "user_id").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    return _shares(once.groupBy(*keys).agg(*_rates()).drop("_level"))


def _rates() -> list[Column]:
    known = F.col("user_id").isNotNull()
    return [
        F.sum("n").alias("sessions"),
        F.sum("c").alias("crashed_sessions"),
        F.count_if(known).alias("users"),
        F.count_if(known & (F.col("c") > 0)).alias("crashed_users"),
    ]


def _shares(df: DataFrame) -> DataFrame:
    return df.withColumn("crash_free_sessions", 1 - F.col("crashed_sessions") / F.col("sessions")).withColumn(
        "crash_free_users", F.when(F.col("users") > 0, 1 - F.col("crashed_users") / F.col("users"))
    )


def reconcile_sessions(sessions: DataFrame, errors: DataFrame) -> DataFrame:
    """Raise session statuses by the errors that carry their id; a crash is never lowered."""
    worst = (
        errors.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.max(F.when(F.col("level") == "fatal", 3).otherwise(1)).alias("_rank"))
    )
    joined = sessions.join(worst, "session_id", "left")
    rank = F.greatest(status_rank(F.col("status")), F.coalesce("_rank", F.lit(0)))
    return joined.withColumn("status", status_name(rank)).drop("_rank")
