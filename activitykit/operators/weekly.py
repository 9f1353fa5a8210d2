"""Weekly active users and sessions.

Both counts are distinct counts per KST Monday week. Spark plans them as a
partial distinct on (week, id) → shuffle on (week, id) → count per week, so a
hot user or a hot week is spread over the (week, id) hash space.

When the input has the day partition column ``event_date_kst``, a week range
also adds the implied day range [first Monday, last Monday + 6], which lets the
scan skip whole day partitions. It is exact: a user's activity in a week lies on
that week's days, and a session's first event lies on its start day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.functions.time import week_start


def week_filter(column: str, week_from: str | None = None, week_to: str | None = None) -> Column | None:
    """Both bounds → BETWEEN; one → >= or <=; none → no filter."""
    c = F.col(column)
    lo = _date_lit(week_from) if week_from else None
    hi = _date_lit(week_to) if week_to else None
    if lo is not None and hi is not None:
        return c.between(lo, hi)
    if lo is not None:
        return c >= lo
    if hi is not None:
        return c <= hi
    return None


def _date_lit(iso: str) -> Column:
    return F.lit(dt.date.fromisoformat(iso).isoformat()).cast("date")


def _day_prune(df: DataFrame, week_from: str | None, week_to: str | None) -> DataFrame:
    if "event_date_kst" not in df.columns or not (week_from or week_to):
        return df
    last_day = (dt.date.fromisoformat(week_to) + dt.timedelta(days=6)).isoformat() if week_to else None
    return df.where(week_filter("event_date_kst", week_from, last_day))


def _filtered(df: DataFrame, week_col: str, week_from: str | None, week_to: str | None) -> DataFrame:
    cond = week_filter(week_col, week_from, week_to)
    if cond is None:
        return df
    return _day_prune(df, week_from, week_to).where(cond)


def weekly_users(df: DataFrame, week_from: str | None = None, week_to: str | None = None) -> DataFrame:
    """(week_start_kst, wau_users): distinct users per week, ordered by week."""
    return (
        _filtered(df, "week_start_kst", week_from, week_to)
        .groupBy("week_start_kst")
        .agg(F.count_distinct("user_id").alias("wau_users"))
        .orderBy("week_start_kst")
    )


def weekly_sessions(df: DataFrame, week_from: str | None = None, week_to: str | None = None) -> DataFrame:
    """(week_start_kst, weekly_active_sessions): distinct sessions by their start week."""
    return (
        _filtered(df, "session_start_week_kst", week_from, week_to)
        .select("session_id", F.col("session_start_week_kst").alias("week_start_kst"))
        .distinct()
        .groupBy("week_start_kst")
        .agg(F.count(F.lit(1)).alias("weekly_active_sessions"))
        .orderBy("week_start_kst")
    )


def affected_weeks(spark: SparkSession, start_date: str, end_date: str) -> DataFrame:
    """Mondays from the week of ``start_date`` to the week of ``end_date``, inclusive."""
    return affected_weeks_of(
        spark.range(1).select(
            _date_lit(start_date).alias("start_date"),
            _date_lit(end_date).alias("end_date"),
        )
    )


def affected_weeks_of(bounds: DataFrame) -> DataFrame:
    """Same, for (start_date, end_date) rows computed by Spark (one week per row)."""
    return bounds.select(
        F.explode(
            F.sequence(week_start("start_date"), week_start("end_date"), F.expr("INTERVAL 7 DAYS"))
        ).alias("week_start_kst")
    )


def weekly_summary(weekly: DataFrame) -> DataFrame:
    """Number of weeks and first/last week of a weekly result."""
    return weekly.agg(
        F.count(F.lit(1)).alias("week_count"),
        F.min("week_start_kst").alias("start_week"),
        F.max("week_start_kst").alias("end_week"),
    )


def with_all_weeks(weekly: DataFrame, weeks: DataFrame, value_col: str) -> DataFrame:
    """Gives every affected week a row (0 when it had no activity), so rewriting a
    week's partition can never leave a stale count behind."""
    return (
        weeks.join(weekly, "week_start_kst", "left")
        .select("week_start_kst", F.coalesce(F.col(value_col), F.lit(0)).cast("long").alias(value_col))
    )


# The same two aggregates as parameterized SQL over a catalog table or view. The
# table is bound with IDENTIFIER and the bounds as typed parameters, so nothing is
# spliced into the text; NULL bounds fold away and the rest reaches the scan.
_RANGE = """
  (:week_from IS NULL OR {week} >= :week_from)
  AND (:week_to IS NULL OR {week} <= :week_to)
  AND (:day_from IS NULL OR event_date_kst >= :day_from)
  AND (:day_to IS NULL OR event_date_kst <= :day_to)"""

WAU_USERS_SQL = f"""
SELECT week_start_kst, COUNT(DISTINCT user_id) AS wau_users
FROM IDENTIFIER(:table)
WHERE {_RANGE.format(week="week_start_kst")}
GROUP BY week_start_kst
ORDER BY week_start_kst"""

WEEKLY_SESSIONS_SQL = f"""
WITH sessions AS (
  SELECT DISTINCT session_id, session_start_week_kst AS week_start_kst
  FROM IDENTIFIER(:table)
  WHERE {_RANGE.format(week="session_start_week_kst")}
)
SELECT week_start_kst, COUNT(*) AS weekly_active_sessions
FROM sessions
GROUP BY week_start_kst
ORDER BY week_start_kst"""


def _sql_args(table: str, week_from: str | None, week_to: str | None) -> dict:
    def d(v):
        return dt.date.fromisoformat(v) if v else None

    last_day = (dt.date.fromisoformat(week_to) + dt.timedelta(days=6)).isoformat() if week_to else None
    return {
        "table": table,
        "week_from": d(week_from),
        "week_to": d(week_to),
        "day_from": d(week_from),
        "day_to": d(last_day),
    }


def weekly_users_sql(spark: SparkSession, table: str, week_from: str | None = None,
                     week_to: str | None = None) -> DataFrame:
    """O39 as SQL over a table with event_date_kst, week_start_kst and user_id."""
    return spark.sql(WAU_USERS_SQL, args=_sql_args(table, week_from, week_to))


def weekly_sessions_sql(spark: SparkSession, table: str, week_from: str | None = None,
                        week_to: str | None = None) -> DataFrame:
    """O40 as SQL: distinct (session, start week) in a CTE, then a count per week."""
    return spark.sql(WEEKLY_SESSIONS_SQL, args=_sql_args(table, week_from, week_to))
