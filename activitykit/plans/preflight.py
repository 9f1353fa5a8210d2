"""What a run checks before it touches data, and a Spark profile of its input.

``problems`` lists everything wrong with a configuration (an empty list: the run may
start); ``preflight`` raises with the whole list. A run_id is single use: a folder of
an earlier run under any per-run base is a problem. Folders are looked up through the
session's Hadoop FileSystem, so HDFS and object stores work too.

``input_profile`` is one aggregate over the normalized input: per KST day the rows, and
how many lie in the run's range; rows without a readable time share one NULL day.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.functions.reasons import is_invalid
from activitykit.schema import KST_ZONE, STATUS_RUNNING, STATUS_SUCCESS
from activitykit.sources import fs
from activitykit.sources.versions import version_path

#: Per-run folders, by the configuration field of their base.
RUN_FOLDERS = {"staging_base_path": "staging", "dlq_base_path": "dead-letter", "run_log_base_path": "run log"}


class PreflightError(ValueError):
    pass


def run_path(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/run_id={run_id}"


def today_kst() -> dt.date:
    return dt.datetime.now(ZoneInfo(KST_ZONE)).date()


def iso_day(value: str | None) -> dt.date | None:
    """The day written as yyyy-MM-dd, None for anything else."""
    try:
        day = dt.date.fromisoformat(value)
    except (TypeError, ValueError):
        return None
    return day if day.isoformat() == value else None


def problems(spark: SparkSession, config, today: dt.date | None = None) -> list[str]:
    """Everything that keeps the run from starting, in words."""
    latest = today or today_kst()
    days = {name: iso_day(getattr(config, name)) for name in ("start_date", "end_date")}
    found = [f"{name} is not a yyyy-MM-dd day: {getattr(config, name)}" for name, day in days.items() if day is None]
    found += [f"{name} lies in the future: {day}" for name, day in days.items() if day and day > latest]
    if all(days.values()) and days["end_date"] < days["start_date"]:
        found.append(f"the range ends before it starts: {days['start_date']} to {days['end_date']}")
    if not (config.output_base_path or "").strip():
        found.append("no output_base_path for the published table")
    if config.input_path is not None and not fs.exists(spark, config.input_path):
        found.append(f"no input at {config.input_path}")
    return found + (_not_resumable(spark, config) if getattr(config, "resume", False) else _already_used(spark, config))


def _already_used(spark: SparkSession, config) -> list[str]:
    paths = {what: run_path(getattr(config, base), config.run_id) for base, what in RUN_FOLDERS.items()}
    if (config.output_base_path or "").strip():
        paths["version"] = version_path(config.output_base_path, config.run_id)
    return [f"run_id {config.run_id} already has a {what} folder: {path}" for what, path in paths.items() if fs.exists(spark, path)]


def _not_resumable(spark: SparkSession, config) -> list[str]:
    """A run goes on only with the range it began with, and only if it has not succeeded."""
    from activitykit.plans.run_log import journal

    records = journal(spark, config.run_log_base_path, config.run_id)
    if not records:
        return [f"run_id {config.run_id} has no run log to resume from"]
    if STATUS_SUCCESS in records:
        return [f"run_id {config.run_id} has succeeded"]
    begun = records.get(STATUS_RUNNING, {})
    if (begun.get("processing_start_date"), begun.get("processing_end_date")) != (config.start_date, config.end_date):
        return [f"run_id {config.run_id} was begun for another range"]
    return []


def preflight(spark: SparkSession, config, today: dt.date | None = None) -> None:
    """Raises :class:`PreflightError` with all problems found."""
    found = problems(spark, config, today)
    if found:
        raise PreflightError("; ".join(found))


def input_profile(normalized: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """(event_date_kst, row_count, invalid_count, in_range_count) per KST day; a NULL day holds unreadable times."""
    in_range = F.col("event_date_kst").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date"))
    return normalized.groupBy("event_date_kst").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(is_invalid()).alias("invalid_count"),
        F.count_if(in_range & ~is_invalid()).alias("in_range_count"),
    )
