"""One batch run, from raw input to published day partitions and weekly results.

Order kept from the reference job: preflight → normalize → validate → dedup →
sessionize (seeded by the snapshot of start_date − 1) → quality gate → publish →
snapshot of end_date → catalog registration → weekly users and sessions for the
affected weeks only. Every phase appends a run-log record when it starts; any
error appends FAILED and is re-raised.

Spark jobs, and what they read:
  1. input counts: one aggregate over the input, which also fills the persisted copy;
  2. dead-letter write, and its reasons counted from the written files;
  3. user row counts (a partial aggregate on two columns) to find hot users;
  4. version write: validate → dedup → sessionize → rebalance by day → parquet, into the
     run's own version folder, where no reader looks;
  5. output, duplicate and session counts: an aggregate over two columns of those files;
  6. repair of later days already published (``plans/repair.py``), if there are any;
  7. publish: the next manifest (metadata only), see ``sources/versions.py``;
  8. snapshot: a max-struct aggregate over the run's days;
  9. weekly: parameterized SQL over the catalog table (distinct users, distinct
     sessions), pruned to the affected weeks' days.

Counts are aggregates over an input or over written files, never accumulators on the way to a
shuffle: tasks that run again after an executor is lost cannot be counted twice.

Resuming. The run log is the journal of a run: a DEDUPLICATING record says that the dead-letter
files and the input counts it carries are final, a PROMOTING record that the version is whole and
has passed the gate, and a manifest that names the version that it is published. ``resume=True``
goes on with a run that did not end in SUCCESS from the first phase without such a record; phases
that are run again overwrite only what the run itself has written.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.functions.reasons import is_invalid
from activitykit.functions.time import monday_of
from activitykit.operators.dedup import deduplicate
from activitykit.operators.metrics import ratio
from activitykit.operators.normalize import normalize
from activitykit.operators.sessionize import (
    DEFAULT_MAX_USER_ROWS,
    sessionize,
    user_activity_stats,
)
from activitykit.operators.snapshot import build_snapshot, reaching, with_idle_users
from activitykit.operators.validate import filter_kst_range, validate
from activitykit.operators.weekly import affected_weeks, weekly_sessions_sql, weekly_users_sql, with_all_weeks
from activitykit.operators.weekly_state import SESSIONS, USERS, WeeklyState
from activitykit.plans.preflight import PreflightError, preflight, run_path
from activitykit.plans.quality import evaluate
from activitykit.plans.repair import boundary_state, repair_forward
from activitykit.plans.run_log import RunLog, journal
from activitykit.runtime import ensure_utc
from activitykit.schema import (
    ACTIVITY_TABLE,
    SESSION_GAP_SECONDS,
    STATUS_COMPUTING_WAU,
    STATUS_DEDUPLICATING,
    STATUS_FAILED,
    STATUS_NORMALIZING,
    STATUS_PROMOTING,
    STATUS_REGISTERING,
    STATUS_RUNNING,
    STATUS_SESSIONIZING,
    STATUS_SUCCESS,
    STATUS_VALIDATING,
    WAU_USERS_TABLE,
    WEEKLY_SESSIONS_TABLE,
)
from activitykit.sources import catalog, fs, versions
from activitykit.sources.activity_csv import read_activity_csv
from activitykit.sources.sinks import to_table_layout, write_dlq, write_staging, write_weekly
from activitykit.sources.snapshot_store import load_snapshot, save_snapshot


@dataclass(kw_only=True)
class BatchConfig:
    start_date: str
    end_date: str
    run_id: str
    input_path: str | None = None
    output_base_path: str
    staging_base_path: str
    dlq_base_path: str
    session_state_base_path: str
    run_log_base_path: str
    wau_output_base_path: str
    table_name: str = ACTIVITY_TABLE
    wau_users_table: str = WAU_USERS_TABLE
    weekly_sessions_table: str = WEEKLY_SESSIONS_TABLE
    gap_seconds: int = SESSION_GAP_SECONDS
    max_user_rows: int | None = DEFAULT_MAX_USER_ROWS
    persist_input: bool = True
    resume: bool = False
    #: Folder of the mergeable weekly state; with it, weeks are merged from day bitmaps instead of recounted from events.
    weekly_state_base_path: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def staging_path(self) -> str:
        """The run's version of the table: its days are written here once, and published from here."""
        return versions.version_path(self.output_base_path, self.run_id)

    @property
    def dlq_path(self) -> str:
        return f"{run_path(self.dlq_base_path, self.run_id)}/invalid"

    @property
    def seed_date(self) -> str:
        return (dt.date.fromisoformat(self.start_date) - dt.timedelta(days=1)).isoformat()

    @property
    def wau_users_path(self) -> str:
        return f"{self.wau_output_base_path.rstrip('/')}/wau-users-by-week"

    @property
    def weekly_sessions_path(self) -> str:
        return f"{self.wau_output_base_path.rstrip('/')}/weekly-active-sessions-by-week"


def _week_list(start_date: str, end_date: str) -> list[str]:
    first, last = dt.date.fromisoformat(monday_of(start_date)), dt.date.fromisoformat(monday_of(end_date))
    return [(first + dt.timedelta(days=7 * i)).isoformat() for i in range((last - first).days // 7 + 1)]


def run_batch(spark: SparkSession, config: BatchConfig, raw: DataFrame | None = None) -> dict:
    """Runs one batch; returns the final metrics. ``raw`` (S0 rows) replaces the CSV scan."""
    ensure_utc(spark)
    log = RunLog(spark, config.run_log_base_path, config.run_id, config.start_date, append=config.resume)
    fresh = not fs.exists(spark, log.path)
    base = dict(
        staging_path=config.staging_path,
        dlq_path=config.dlq_path,
        final_output_path=config.output_base_path,
        processing_start_date=config.start_date,
        processing_end_date=config.end_date,
        snapshot_seed_date=config.seed_date,
        snapshot_target_date=config.end_date,
    )
    try:
        preflight(spark, config)
        done = journal(spark, config.run_log_base_path, config.run_id) if config.resume else {}
        log.log(STATUS_RUNNING, **base)
        return _run(spark, config, raw, log, base, done)
    except Exception as exc:
        if isinstance(exc, PreflightError) and not fresh:
            raise  # a refused attempt leaves no record in the log of the run that has the id
        try:
            log.log(STATUS_FAILED, message=str(exc), **base)
        except Exception:  # the original error matters more than a failed log write
            pass
        raise


def _run(spark: SparkSession, config: BatchConfig, raw: DataFrame | None, log: RunLog, base: dict, done: dict[str, dict]) -> dict:
    if STATUS_PROMOTING in done:
        counts = _input_counts(done[STATUS_DEDUPLICATING])
    else:
        counts = _write_version(spark, config, raw, log, base, done)
    counts, rows = _version_counts(spark, config, counts)
    counts["quality_gate_warnings"] = evaluate(
        counts["input_row_count"], counts["output_row_count"], counts["dlq_ratio"], counts["invalid_reason_summary"]
    ).warnings
    dates = [d for d in versions.version_days(spark, config.output_base_path, config.run_id) if config.start_date <= d <= config.end_date]
    m = counts | dict(
        output_partition_count=len(dates),
        output_partition_start=dates[0] if dates else None,
        output_partition_end=dates[-1] if dates else None,
    )

    # Repair the later days, publish all days at once, then snapshot the end date from the run's files.
    log.log(
        STATUS_PROMOTING,
        quality_gate_warnings=m["quality_gate_warnings"],
        output_row_count=m["output_row_count"],
        unique_session_count=m["unique_session_count"],
        output_partition_count=m["output_partition_count"],
        output_partition_start=m["output_partition_start"],
        output_partition_end=m["output_partition_end"],
        **base,
    )
    published = versions.current(spark, config.output_base_path)
    before = _without(spark, config, published)
    repair = repair_forward(
        spark, config.output_base_path, before, config.run_id, dates, config.end_date, config.gap_seconds,
        config.session_state_base_path, config.max_user_rows,
    )
    m["repaired_days"] = repair.days
    versions.publish_version(spark, config.output_base_path, config.run_id, dates + repair.days, rows=None if repair.days else rows)
    previous = _previous_state(spark, config)
    mine = versions.read_days(spark, config.output_base_path, {d: config.run_id for d in dates})
    snapshot = with_idle_users(build_snapshot(mine, config.end_date, config.run_id), previous, config.end_date, config.gap_seconds)
    m["session_snapshot_path"] = save_snapshot(snapshot, config.session_state_base_path, config.end_date)
    dates = dates + repair.days

    log.log(
        STATUS_REGISTERING,
        unique_session_count=m["unique_session_count"],
        session_snapshot_path=m["session_snapshot_path"],
        output_partition_count=m["output_partition_count"],
        output_partition_start=m["output_partition_start"],
        output_partition_end=m["output_partition_end"],
        **base,
    )
    catalog.create_activity_table(spark, config.table_name, config.output_base_path)
    m["registered_hive_partitions_count"] = len(versions.point_table(spark, config.table_name, config.output_base_path, days=dates))

    last_day = max([config.end_date, *repair.days])
    week_from, week_to = monday_of(config.start_date), monday_of(last_day)
    message = f"affected_week_start={week_from}; affected_week_end={week_to}"
    log.log(
        STATUS_COMPUTING_WAU,
        unique_session_count=m["unique_session_count"],
        registered_hive_partitions_count=m["registered_hive_partitions_count"],
        session_snapshot_path=m["session_snapshot_path"],
        message=message,
        **base,
    )
    m.update(_weekly(spark, config, last_day, week_from, week_to))
    m["message"] = message
    log.log(STATUS_SUCCESS, **base, **{k: v for k, v in m.items() if k in _SUCCESS_FIELDS})
    return m


def _previous_state(spark: SparkSession, config: BatchConfig) -> DataFrame | None:
    """The end states of the day before the range: its saved snapshot, else those of the published days."""
    saved = load_snapshot(spark, config.session_state_base_path, config.seed_date)
    if saved is not None:
        return saved
    days = {d: e["version"] for d, e in versions.current(spark, config.output_base_path).days.items()}
    return boundary_state(spark, config.output_base_path, days, config.seed_date, config.gap_seconds, config.run_id)


def _without(spark: SparkSession, config: BatchConfig, manifest: versions.Manifest) -> versions.Manifest:
    """``manifest``, or the newest one that does not name this run's version (a resumed run may have published)."""
    number = manifest.number
    while manifest is None or any(e["version"] == config.run_id for e in manifest.days.values()):
        number -= 1
        manifest = versions.read_manifest(spark, config.output_base_path, number) if number > 0 else versions.Manifest()
    return manifest


def _write_version(
    spark: SparkSession, config: BatchConfig, raw: DataFrame | None, log: RunLog, base: dict, done: dict[str, dict]
) -> dict:
    """Writes the dead letters and the run's version; returns the input's counts."""
    if raw is None:
        raw = read_activity_csv(spark, config.input_path, keep_malformed=True)
    log.log(STATUS_NORMALIZING, **base)
    normalized = normalize(raw, config.run_id)
    if config.persist_input:
        normalized = normalized.persist(StorageLevel.DISK_ONLY)

    log.log(STATUS_VALIDATING, **base)
    known = done.get(STATUS_DEDUPLICATING)
    if known is None:
        input_rows, invalid_rows = normalized.agg(F.count(F.lit(1)), F.count_if(is_invalid())).first()
        write_dlq(validate(normalized, config.start_date).invalid, config.dlq_path)
        reasons = {
            r["reject_reason"]: r["count"]
            for r in spark.read.parquet(config.dlq_path).groupBy("reject_reason").count().collect()
        } if invalid_rows else {}
        dlq_rate = ratio(invalid_rows, input_rows)
        known = dict(input_row_count=input_rows, invalid_row_count=invalid_rows, dlq_ratio=dlq_rate, invalid_reason_summary=reasons)
    known = _input_counts(known)

    in_range = filter_kst_range(validate(normalized, config.start_date).valid, config.start_date, config.end_date)
    log.log(STATUS_DEDUPLICATING, **known, **base)
    dedup = deduplicate(in_range, keep_group_size=True).deduplicated
    log.log(STATUS_SESSIONIZING, **base)
    previous = _previous_state(spark, config)
    seeds = None if previous is None else reaching(previous, config.start_date, config.gap_seconds)
    stats = user_activity_stats(in_range) if config.max_user_rows is not None else None
    sess = sessionize(
        dedup,
        seeds,
        gap_seconds=config.gap_seconds,
        max_user_rows=config.max_user_rows,
        user_stats=stats,
        with_session_opened=True,
    )
    write_staging(to_table_layout(sess, COUNTED_COLUMNS), config.staging_path)
    if config.persist_input:
        normalized.unpersist()
    return known


def _input_counts(record: dict) -> dict:
    names = ("input_row_count", "invalid_row_count", "dlq_ratio", "invalid_reason_summary")
    return {n: record.get(n) for n in names} | {"invalid_reason_summary": record.get("invalid_reason_summary") or {}}


def _version_counts(spark: SparkSession, config: BatchConfig, counts: dict) -> tuple[dict, dict[str, int]]:
    """``counts`` with those of the run's written days, and the rows of each day."""
    size = F.col("duplicate_group_size")
    held = [d for d in versions.version_days(spark, config.output_base_path, config.run_id) if config.start_date <= d <= config.end_date]
    days = versions.read_days(spark, config.output_base_path, {d: config.run_id for d in held}).groupBy("event_date_kst").agg(
        F.count(F.lit(1)).alias("output_row_count"),
        F.sum(size).cast("long").alias("valid_row_count"),
        F.count_if(size > 1).alias("duplicate_group_count"),
        F.sum(F.when(size > 1, size).otherwise(0)).cast("long").alias("duplicate_rows_count"),
        F.sum(size - 1).cast("long").alias("dropped_duplicate_rows_count"),
        F.count_if("session_opened").alias("unique_session_count"),
    ).collect() if held else []  # a row a day
    names = ["output_row_count", "valid_row_count", "duplicate_group_count", "duplicate_rows_count", "dropped_duplicate_rows_count", "unique_session_count"]
    found = counts | {n: sum(r[n] for r in days) for n in names}
    found["out_of_range_row_count"] = found["input_row_count"] - found["invalid_row_count"] - found["valid_row_count"]
    return found, {str(r["event_date_kst"]): r["output_row_count"] for r in days}


#: Columns beside the table's own that a version's files carry, so that counts can be taken from them.
COUNTED_COLUMNS = ["duplicate_group_size", "session_opened"]

_SUCCESS_FIELDS = {
    "quality_gate_warnings", "input_row_count", "valid_row_count", "invalid_row_count", "out_of_range_row_count",
    "output_row_count", "duplicate_group_count", "duplicate_rows_count", "dropped_duplicate_rows_count",
    "dlq_ratio", "invalid_reason_summary", "output_partition_count", "output_partition_start",
    "output_partition_end", "unique_session_count", "registered_hive_partitions_count",
    "session_snapshot_path", "message", "wau_users_output_path", "weekly_active_sessions_output_path",
    "wau_users_week_count", "wau_users_start_week", "wau_users_end_week", "weekly_active_sessions_week_count",
    "weekly_active_sessions_start_week", "weekly_active_sessions_end_week",
}


def _weekly(spark: SparkSession, config: BatchConfig, last_day: str, week_from: str, week_to: str) -> dict:
    """Recomputes only the affected weeks from the catalog table and rewrites only
    their partitions. Every affected week gets a row (0 if it has no activity)."""
    weeks = affected_weeks(spark, config.start_date, last_day)
    week_values = _week_list(config.start_date, last_day)
    out = {}
    for prefix, recount, merged, metric, path, name in [
        ("wau_users", weekly_users_sql, USERS, "wau_users", config.wau_users_path, config.wau_users_table),
        ("weekly_active_sessions", weekly_sessions_sql, SESSIONS, "weekly_active_sessions",
         config.weekly_sessions_path, config.weekly_sessions_table),
    ]:
        if config.weekly_state_base_path:
            result = _merged_weeks(spark, config, merged, week_from, week_to)
        else:
            result = recount(spark, config.table_name, week_from, week_to)
        write_weekly(with_all_weeks(result, weeks, metric), path)
        catalog.create_weekly_table(spark, name, metric, path)
        catalog.add_week_partitions(spark, name, path, week_values)
        # The written result is a handful of rows (one per affected week).
        rows = (
            spark.read.parquet(path)
            .where(F.col("week_start_kst").between(F.lit(week_from).cast("date"), F.lit(week_to).cast("date")))
            .where(F.col(metric) > 0)
            .agg(F.count(F.lit(1)).alias("n"), F.min("week_start_kst").alias("lo"), F.max("week_start_kst").alias("hi"))
            .first()
        )
        out[f"{prefix}_output_path"] = path
        out[f"{prefix}_week_count"] = rows["n"]
        out[f"{prefix}_start_week"] = rows["lo"].isoformat() if rows["lo"] else None
        out[f"{prefix}_end_week"] = rows["hi"].isoformat() if rows["hi"] else None
    return out


def _merged_weeks(spark: SparkSession, config: BatchConfig, metric: tuple[str, str, str], week_from: str, week_to: str) -> DataFrame:
    """The weeks' counts from the mergeable state, after this run's days (and days it lacks) are put into it."""
    state = WeeklyState(spark, config.weekly_state_base_path, metric)
    manifest = versions.current(spark, config.output_base_path)
    last = (dt.date.fromisoformat(week_to) + dt.timedelta(days=6)).isoformat()
    held = set(state.days())
    days = [d for d, e in manifest.days.items() if e["version"] == config.run_id or (week_from <= d <= last and d not in held)]
    if days:
        state.update(versions.read_current(spark, config.output_base_path, days, manifest), days)
    return state.counts(week_from, week_to)
