"""Time expressions: UTC parse, KST wall clock, KST date and Monday week.

KST values are shifted wall-clock instants (``from_utc_timestamp``); they read
correctly under a UTC session time zone, which ``ensure_utc`` enforces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activitykit.schema import EVENT_TIME_PATTERN, KST_ZONE, WEEK_START_DAY


def parse_event_time(col: Column | str) -> Column:
    """UTC text such as ``2019-10-01 00:00:00 UTC`` → timestamp; NULL if unparsable."""
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col, F.lit(EVENT_TIME_PATTERN))


def to_kst(ts: Column | str) -> Column:
    return F.from_utc_timestamp(F.col(ts) if isinstance(ts, str) else ts, KST_ZONE)


def week_start(date: Column | str) -> Column:
    """Monday on or before ``date``."""
    d = F.col(date) if isinstance(date, str) else date
    return F.date_sub(F.next_day(d, WEEK_START_DAY), 7)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch; sub-seconds are cut, not rounded."""
    return F.unix_timestamp(F.col(ts) if isinstance(ts, str) else ts)


def epoch_millis(ts: Column | str) -> Column:
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def monday_of(date_text: str) -> str:
    """Monday on or before an ISO date, on the driver (for path and filter literals)."""
    import datetime as _dt

    d = _dt.date.fromisoformat(date_text)
    return (d - _dt.timedelta(days=d.weekday())).isoformat()
