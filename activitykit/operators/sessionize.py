"""Inactivity-gap sessions that continue across runs.

Rule: within a user, ordered by (event_time_utc, product_id, event_type,
dedup_key), an event opens a new session when it has no predecessor or when the
whole-second gap to its predecessor is >= ``gap_seconds``. A session's start is
the time of the event that opened it; its id is sha256(user_id || start millis).

Continuation across runs. The previous run's snapshot (one row per user) is
unioned in as a *seed row* that sorts before all of the user's events: its
``last_event_time_utc`` is the predecessor of the first event and its
``last_session_start_time_utc`` is the start the continued session keeps. A seed
only continues a session when 0 <= gap < gap_seconds; a negative gap (snapshot
later than the new events) opens a new session. So the carry-over needs no join:
it is the same window pass as the local sessions, on the same shuffle.

Skew. A window partitioned by user sends all of a user's rows to one task. Gaps
are whole seconds and at least one, so of all events a user has in one second only
the first can open a session. Users with more than ``max_user_rows`` rows are
therefore reduced to one row per second (a partial aggregate, which collapses a
burst inside each map task), the same window pass runs over those seconds, and the
rows take their second's session by a join on (user_id, second), which the
adaptive skew join can split. A window task then holds at most the seconds of the
input's time span, whatever the number of rows. The ids of those users are written
as a small table first, so Spark broadcasts them only when their measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from activitykit.functions.keys import session_id
from activitykit.functions.time import epoch_seconds, to_kst, week_start
from activitykit.runtime import scratch_path
from activitykit.schema import SESSION_COLUMNS, SESSION_GAP_SECONDS, SESSION_ORDER

DEFAULT_MAX_USER_ROWS = 2_000_000


def user_activity_stats(df: DataFrame) -> DataFrame:
    """Rows per user (a partial aggregate, skew-safe)."""
    return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_rows"))


def _hot_users(stats: DataFrame, max_user_rows: int) -> DataFrame | None:
    """The users above ``max_user_rows`` as a written table, or None when there are none."""
    spark = stats.sparkSession
    path = scratch_path(spark, "hot-users")
    stats.where(F.col("_rows") > F.lit(max_user_rows)).select("user_id").write.parquet(path)
    hot = spark.read.parquet(path)
    return None if hot.isEmpty() else hot


def _seed_rows(snapshot: DataFrame | None) -> DataFrame | None:
    if snapshot is None:
        return None
    return snapshot.where(F.col("last_event_time_utc").isNotNull()).select(
        F.col("user_id"),
        F.col("last_event_time_utc").alias("event_time_utc"),
        F.col("last_session_start_time_utc").alias("_carry_start"),
        F.lit(0).alias("_src"),
    )


def _window_pass(df: DataFrame, seeds: DataFrame | None, gap_seconds: int) -> DataFrame:
    """``df`` plus session_start_time_utc and session_opened (true on a session's first row in ``df``)."""
    t = F.col("event_time_utc")
    rows = df.withColumns({"_src": F.lit(1), "_carry_start": F.lit(None).cast("timestamp")})
    if seeds is not None:
        rows = rows.unionByName(seeds, allowMissingColumns=True)
    w = Window.partitionBy("user_id").orderBy("_src", *SESSION_ORDER)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev_t = F.lag(t).over(w)
    gap = epoch_seconds(t) - epoch_seconds(prev_t)
    is_new = (F.col("_src") == 1) & (prev_t.isNull() | (gap >= F.lit(gap_seconds)) | (gap < F.lit(0)))
    after_seed = F.coalesce(F.lag("_src").over(w) == F.lit(0), F.lit(False))
    marked = (
        rows.withColumn("_is_new", is_new)
        .withColumn("_after_seed", after_seed)
        # New-session starts rise along the order, so the running max is the last one.
        .withColumn("_run_start", F.max(F.when(F.col("_is_new"), t)).over(running))
        .withColumn("_run_carry", F.max("_carry_start").over(running))
    )
    return marked.where(F.col("_src") == 1).select(
        *df.columns,
        F.coalesce(F.col("_run_start"), F.col("_run_carry")).alias("session_start_time_utc"),
        (F.col("_is_new") | F.col("_after_seed")).alias("session_opened"),
    )


def _by_seconds(rows: DataFrame, seeds: DataFrame | None, gap_seconds: int) -> DataFrame:
    """The same columns as :func:`_window_pass`, by way of one row per user and second."""
    sec = epoch_seconds("event_time_utc")
    firsts = rows.groupBy("user_id", sec.alias("_sec")).agg(F.min(F.struct(*SESSION_ORDER)).alias("_first"))
    seconds = _window_pass(firsts.select("user_id", "_sec", "_first.*"), seeds, gap_seconds).select(
        "user_id",
        "_sec",
        F.col("dedup_key").alias("_first_key"),
        "session_start_time_utc",
        F.col("session_opened").alias("_opened"),
    )
    return rows.withColumn("_sec", sec).join(seconds, ["user_id", "_sec"]).select(
        *rows.columns,
        "session_start_time_utc",
        (F.col("_opened") & F.col("dedup_key").eqNullSafe(F.col("_first_key"))).alias("session_opened"),
    )


def sessionize(
    df: DataFrame,
    previous_snapshot: DataFrame | None = None,
    gap_seconds: int = SESSION_GAP_SECONDS,
    max_user_rows: int | None = DEFAULT_MAX_USER_ROWS,
    user_stats: DataFrame | None = None,
    with_session_opened: bool = False,
) -> DataFrame:
    """Deduplicated rows (S3) → rows with session_start_time_utc/kst,
    session_start_week_kst and session_id (S4), same row count.

    ``user_stats`` (from :func:`user_activity_stats`, on this input or on any cheaper
    source of per-user counts) saves the pre-pass that finds hot users; it only
    decides which users go by seconds, never the result; ``max_user_rows=None`` skips
    the pre-pass. ``with_session_opened`` keeps a boolean ``session_opened`` that is
    true on the first row of each session id, so the number of sessions is a plain sum.
    """
    if gap_seconds <= 0:
        raise ValueError(f"gap_seconds must be positive: {gap_seconds}")
    seeds = _seed_rows(previous_snapshot)
    hot = None
    if max_user_rows is not None:
        hot = _hot_users(user_stats if user_stats is not None else user_activity_stats(df), max_user_rows)
    if hot is None:
        timed = _window_pass(df, seeds, gap_seconds)
    else:
        hot_seeds = None if seeds is None else seeds.join(hot, "user_id", "left_semi")
        timed = _window_pass(df.join(hot, "user_id", "left_anti"), seeds, gap_seconds).unionByName(
            _by_seconds(df.join(hot, "user_id", "left_semi"), hot_seeds, gap_seconds)
        )
    start = F.col("session_start_time_utc")
    start_kst = to_kst(start)
    result = timed.select(
        *df.columns,
        start,
        start_kst.alias("session_start_time_kst"),
        week_start(F.to_date(start_kst)).alias("session_start_week_kst"),
        session_id("user_id", start).alias("session_id"),
        "session_opened",
    )
    assert result.columns[-5:-1] == SESSION_COLUMNS
    return result if with_session_opened else result.drop("session_opened")


def first_event_per_user(df: DataFrame) -> DataFrame:
    """Earliest event time per user."""
    return df.groupBy("user_id").agg(F.min("event_time_utc").alias("first_event_time_utc"))
