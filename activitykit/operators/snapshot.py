"""The per-user state a later run continues sessions from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.schema import KST_ZONE, SESSION_ORDER


def build_snapshot(sessionized: DataFrame, snapshot_date_kst: str, run_id: str) -> DataFrame:
    """One row per user: the session and times of the user's last event.

    "Last" is the greatest (event_time_utc, product_id, event_type, dedup_key).
    It is taken with ``max`` over a struct led by those keys, an aggregate with a
    map-side partial step, so a user with a huge share of rows is reduced inside
    each map task rather than sorted whole in one task.
    """
    last = F.max(
        F.struct(
            *[F.col(c) for c in SESSION_ORDER],
            F.col("session_id"),
            F.col("session_start_time_utc"),
            F.col("event_time_kst"),
        )
    ).alias("_last")
    return sessionized.groupBy("user_id").agg(last).select(
        F.lit(snapshot_date_kst).alias("snapshot_date_kst"),
        F.col("user_id"),
        F.col("_last.session_id").alias("last_session_id"),
        F.col("_last.session_start_time_utc").alias("last_session_start_time_utc"),
        F.col("_last.event_time_utc").alias("last_event_time_utc"),
        F.col("_last.event_time_kst").alias("last_event_time_kst"),
        F.current_timestamp().alias("updated_at"),
        F.lit(run_id).alias("run_id"),
    )


def latest_state_per_user(*states: DataFrame) -> DataFrame:
    """Of all states given, each user's row with the greatest last event (a partial aggregate)."""
    columns = states[0].columns
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state.select(*columns))
    order = ["last_event_time_utc", "last_session_start_time_utc"]
    rest = [c for c in columns if c not in ("user_id", *order)]
    best = every.groupBy("user_id").agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c == "user_id" else F.col(f"_best.{c}").alias(c) for c in columns])


def reaching(snapshot: DataFrame, start_date_kst: str, gap_seconds: int) -> DataFrame:
    """The users whose last event the gap still reaches at the start of the day: a filter the scan can use."""
    day_start = F.to_utc_timestamp(F.lit(f"{start_date_kst} 00:00:00").cast("timestamp"), F.lit(KST_ZONE))
    reach = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    return snapshot.where(F.col("last_event_time_utc") > day_start - reach)


def with_idle_users(snapshot: DataFrame, previous: DataFrame | None, end_date_kst: str, gap_seconds: int) -> DataFrame:
    """``snapshot`` plus the previous one's users whose last event the gap still reaches after the day's end.

    Under a gap of a day or less no idle user is that recent; longer gaps carry them on.
    """
    if previous is None:
        return snapshot
    day_end = F.lit(f"{end_date_kst} 15:00:00").cast("timestamp")  # midnight KST, in UTC
    reached = F.col("last_event_time_utc") > day_end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    return latest_state_per_user(snapshot, previous.where(reached))
