"""The running session number of each user, without a window over a user's rows.

The number of a row is how many of the run's sessions the user has opened up to and including
the row's own; a session continued from the snapshot is the user's first. Session starts of one
user are distinct whole-second steps, so the number is the rank of the session's start among the
user's starts, and only the sessions, not their rows, have to be put in order:

1. one row per session (a partial aggregate, which collapses a session's rows in the map tasks);
2. sessions per (user, range of ``range_seconds``), a partial aggregate again, and a running sum
   over a user's ranges: the sessions before each range;
3. the rank of a session inside its range, added to the sum before the range;
4. the rows take their session's number by a join on (user, start), which the adaptive skew join
   can split when one session or user holds a large share of the rows.

A window task of step 2 holds at most the time span / ``range_seconds`` rows a user, one of step 3
at most ``range_seconds`` rows, whatever the number of events. Both are plain columns of small
types, and neither step sees the events' other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from activitykit.functions.time import epoch_seconds

DEFAULT_RANGE_SECONDS = 86_400


def numbered_sessions(sessions: DataFrame, range_seconds: int = DEFAULT_RANGE_SECONDS) -> DataFrame:
    """Sessionized rows → (user_id, session_start_time_utc, session_number), one row per session."""
    if range_seconds <= 0:
        raise ValueError(f"range_seconds must be positive: {range_seconds}")
    opened = (
        sessions.select("user_id", "session_start_time_utc")
        .distinct()
        .withColumn("_range", F.floor(epoch_seconds("session_start_time_utc") / F.lit(range_seconds)))
    )
    ranges = opened.groupBy("user_id", "_range").agg(F.count(F.lit(1)).alias("_sessions"))
    earlier = Window.partitionBy("user_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select("user_id", "_range", F.coalesce(F.sum("_sessions").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("user_id", "_range").orderBy("session_start_time_utc"))
    return (
        opened.withColumn("_inside", inside)
        .join(before, ["user_id", "_range"])
        .select("user_id", "session_start_time_utc", (F.col("_before") + F.col("_inside")).cast("long").alias("session_number"))
    )


def with_session_number(sessions: DataFrame, range_seconds: int = DEFAULT_RANGE_SECONDS) -> DataFrame:
    """Sessionized rows (S4) plus ``session_number`` (long, from 1), same row count."""
    numbers = numbered_sessions(sessions, range_seconds)
    return sessions.join(numbers, ["user_id", "session_start_time_utc"]).select(*sessions.columns, "session_number")
