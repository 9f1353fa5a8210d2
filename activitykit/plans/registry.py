"""The registered queries: each reads the driver's tables under ``sf_dir`` and
returns one DataFrame, the same result the reference's job produces for it.

Results meant for value comparison pass through :func:`comparable`: timestamps
as text with microseconds, dates and decimals as text, and the two wall-clock
columns (``ingested_at``, ``updated_at``) left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activitykit.functions.time import to_kst
from activitykit.operators.dedup import deduplicate, duplicate_metrics
from activitykit.operators.metrics import (
    dlq_ratio,
    output_partition_summary,
    output_partitions,
    reason_display,
    reason_histogram,
    stage_counts,
    unique_sessions,
)
from activitykit.operators.normalize import normalize
from activitykit.operators.session_number import with_session_number
from activitykit.operators.sessionize import first_event_per_user, sessionize, user_activity_stats
from activitykit.operators.snapshot import build_snapshot
from activitykit.operators.validate import filter_kst_range, validate
from activitykit.operators.weekly import (
    affected_weeks_of,
    weekly_sessions,
    weekly_summary,
    weekly_users,
)
from activitykit.plans.preflight import input_profile
from activitykit.runtime import ensure_utc
from activitykit.sources.events import events_as_activity, read_events

# Fixed run parameters of the registered queries (the job's command-line values).
RUN_ID = "sf-run"
TARGET_DATE = "2024-01-01"
RANGE_START = "2024-01-08"
RANGE_END = "2024-01-21"
WEEK_FROM = "2024-01-08"
WEEK_TO = "2024-01-22"
FIRST_BATCH_END = "2024-01-15"
SECOND_BATCH_START = "2024-01-16"
SEEDED_GAP_SECONDS = 21_600
SPLIT_MAX_USER_ROWS = 20

WALL_CLOCK_COLUMNS = {"ingested_at", "updated_at"}


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in WALL_CLOCK_COLUMNS:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.DateType, T.DecimalType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ----------------------------------------------------------------------------
# Pipeline stages shared by the queries
# ----------------------------------------------------------------------------
def normalized(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    ensure_utc(spark)
    return normalize(events_as_activity(spark, sf_dir, dirty=dirty), RUN_ID)


def valid_invalid(spark: SparkSession, sf_dir: str):
    return validate(normalized(spark, sf_dir), TARGET_DATE)


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(valid_invalid(spark, sf_dir).valid).deduplicated


def sessionized(spark: SparkSession, sf_dir: str, gap: int = 300, **kw) -> DataFrame:
    return _sessionize_valid(spark, sf_dir, valid_invalid(spark, sf_dir).valid, gap, **kw)


def source_user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per user from a one-column scan of the source table, without the adapter
    and dedup work: all that finding the hot users needs."""
    events = read_events(spark, sf_dir)
    return user_activity_stats(events.select("user_id"))


def _sessionize_valid(
    spark: SparkSession, sf_dir: str, valid: DataFrame, gap: int, previous_snapshot: DataFrame | None = None, **kw
) -> DataFrame:
    return sessionize(
        deduplicate(valid).deduplicated,
        previous_snapshot,
        gap_seconds=gap,
        user_stats=source_user_stats(spark, sf_dir),
        **kw,
    )


def _session_rows(df: DataFrame) -> DataFrame:
    return comparable(
        df.select(
            "raw_user_session",
            "user_id",
            "event_time_utc",
            "dedup_key",
            "session_id",
            "session_start_time_utc",
            "session_start_time_kst",
            "session_start_week_kst",
        )
    )


# ----------------------------------------------------------------------------
# Queries
# ----------------------------------------------------------------------------
def q_normalize_events(spark, sf_dir):
    return comparable(normalized(spark, sf_dir, dirty=False))


def q_valid_rows(spark, sf_dir):
    return comparable(valid_invalid(spark, sf_dir).valid)


def q_invalid_rows(spark, sf_dir):
    return comparable(valid_invalid(spark, sf_dir).invalid.drop("raw_payload"))


def q_raw_payload(spark, sf_dir):
    return valid_invalid(spark, sf_dir).invalid.select("raw_user_session", "raw_payload")


def q_reject_reason_histogram(spark, sf_dir):
    return reason_histogram(valid_invalid(spark, sf_dir).invalid)


def q_reject_reason_top20(spark, sf_dir):
    return reason_display(valid_invalid(spark, sf_dir).invalid, 20)


def q_date_range_filter(spark, sf_dir):
    valid = valid_invalid(spark, sf_dir).valid
    return comparable(filter_kst_range(valid, RANGE_START, RANGE_END).select("raw_user_session", "event_date_kst"))


def q_dedup_rows(spark, sf_dir):
    return comparable(deduplicated(spark, sf_dir))


def q_duplicate_groups(spark, sf_dir):
    return deduplicate(valid_invalid(spark, sf_dir).valid).duplicate_groups


def q_duplicate_metrics(spark, sf_dir):
    return duplicate_metrics(deduplicate(valid_invalid(spark, sf_dir).valid).duplicate_groups)


def q_sessionize(spark, sf_dir, gap):
    return _session_rows(sessionized(spark, sf_dir, gap))


def q_sessionize_hot_split(spark, sf_dir):
    # Every user above 20 rows goes by seconds: the skew path, same result.
    return _session_rows(sessionized(spark, sf_dir, 300, max_user_rows=SPLIT_MAX_USER_ROWS))


def _first_batch(spark, sf_dir, gap, **kw) -> DataFrame:
    """Sessions of the days up to FIRST_BATCH_END, written and read back as a job does."""
    from activitykit.runtime import scratch_path

    valid = valid_invalid(spark, sf_dir).valid
    path = scratch_path(spark, "first-batch")
    _sessionize_valid(spark, sf_dir, filter_kst_range(valid, "0001-01-01", FIRST_BATCH_END), gap, **kw).write.parquet(path)
    return spark.read.parquet(path)


def _second_batch(spark, sf_dir, gap, snapshot, **kw) -> DataFrame:
    valid = valid_invalid(spark, sf_dir).valid
    return _sessionize_valid(spark, sf_dir, filter_kst_range(valid, SECOND_BATCH_START, "9999-12-31"), gap, snapshot, **kw)


def _two_batches(spark, sf_dir, gap, **kw) -> DataFrame:
    """Days up to FIRST_BATCH_END, then the rest seeded by the first run's snapshot."""
    first = _first_batch(spark, sf_dir, gap, **kw)
    return first.unionByName(_second_batch(spark, sf_dir, gap, build_snapshot(first, FIRST_BATCH_END, RUN_ID), **kw))


def q_sessionize_seeded(spark, sf_dir):
    return _session_rows(_two_batches(spark, sf_dir, SEEDED_GAP_SECONDS))


def q_sessionize_seeded_split(spark, sf_dir):
    return _session_rows(_two_batches(spark, sf_dir, SEEDED_GAP_SECONDS, max_user_rows=SPLIT_MAX_USER_ROWS))


def q_session_numbers(spark, sf_dir):
    """Each row with the running number of its session among its user's."""
    return with_session_number(sessionized(spark, sf_dir, 3600)).select("raw_user_session", "user_id", "session_id", "session_number")


def q_first_event_per_user(spark, sf_dir):
    return comparable(first_event_per_user(deduplicated(spark, sf_dir)))


def q_session_snapshot(spark, sf_dir):
    return comparable(build_snapshot(sessionized(spark, sf_dir), "2024-01-31", RUN_ID))


def q_wau_users(spark, sf_dir):
    return comparable(weekly_users(sessionized(spark, sf_dir)))


def q_wau_users_range(spark, sf_dir):
    return comparable(weekly_users(sessionized(spark, sf_dir), WEEK_FROM, WEEK_TO))


def q_weekly_active_sessions(spark, sf_dir):
    return comparable(weekly_sessions(sessionized(spark, sf_dir)))


def q_weekly_active_sessions_range(spark, sf_dir):
    return comparable(weekly_sessions(sessionized(spark, sf_dir), WEEK_FROM, WEEK_TO))


def q_weekly_active_sessions_from(spark, sf_dir):
    return comparable(weekly_sessions(sessionized(spark, sf_dir), week_from=WEEK_FROM))


def q_wau_users_to(spark, sf_dir):
    return comparable(weekly_users(sessionized(spark, sf_dir), week_to=WEEK_TO))


def _view(spark, df: DataFrame, name: str) -> str:
    import uuid

    view = f"{name}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    return view


def q_wau_users_sql(spark, sf_dir):
    from activitykit.operators.weekly import weekly_users_sql

    view = _view(spark, sessionized(spark, sf_dir), "activity_events")
    return comparable(weekly_users_sql(spark, view, WEEK_FROM, WEEK_TO))


def q_weekly_active_sessions_sql(spark, sf_dir):
    from activitykit.operators.weekly import weekly_sessions_sql

    view = _view(spark, sessionized(spark, sf_dir), "activity_events")
    return comparable(weekly_sessions_sql(spark, view, WEEK_FROM, WEEK_TO))


def q_unique_sessions(spark, sf_dir):
    return unique_sessions(sessionized(spark, sf_dir))


def q_output_partitions(spark, sf_dir):
    return comparable(output_partitions(sessionized(spark, sf_dir)))


def q_output_partition_summary(spark, sf_dir):
    return comparable(output_partition_summary(sessionized(spark, sf_dir)))


def q_affected_weeks(spark, sf_dir):
    bounds = normalized(spark, sf_dir, dirty=False).agg(
        F.min("event_date_kst").alias("start_date"), F.max("event_date_kst").alias("end_date")
    )
    return comparable(affected_weeks_of(bounds))


def q_dlq_ratio(spark, sf_dir):
    return dlq_ratio(normalized(spark, sf_dir))


def q_stage_counts(spark, sf_dir):
    return stage_counts(normalized(spark, sf_dir), sessionized(spark, sf_dir))


def q_input_profile(spark, sf_dir):
    return comparable(input_profile(normalized(spark, sf_dir), RANGE_START, RANGE_END))


def q_wau_summary(spark, sf_dir):
    sess = sessionized(spark, sf_dir)
    users = weekly_summary(weekly_users(sess)).select(F.lit("wau_users").alias("result"), "*")
    sessions = weekly_summary(weekly_sessions(sess)).select(F.lit("weekly_active_sessions").alias("result"), "*")
    return comparable(users.unionByName(sessions))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "normalize_events": q_normalize_events,
        "valid_rows": q_valid_rows,
        "invalid_rows": q_invalid_rows,
        "raw_payload": q_raw_payload,
        "reject_reason_histogram": q_reject_reason_histogram,
        "reject_reason_top20": q_reject_reason_top20,
        "date_range_filter": q_date_range_filter,
        "dedup_rows": q_dedup_rows,
        "duplicate_groups": q_duplicate_groups,
        "duplicate_metrics": q_duplicate_metrics,
        "sessionize_300": partial(q_sessionize, gap=300),
        "sessionize_1800": partial(q_sessionize, gap=1800),
        "sessionize_3600": partial(q_sessionize, gap=3600),
        "sessionize_hot_split": q_sessionize_hot_split,
        "sessionize_seeded": q_sessionize_seeded,
        "sessionize_seeded_split": q_sessionize_seeded_split,
        "session_numbers": q_session_numbers,
        "first_event_per_user": q_first_event_per_user,
        "session_snapshot": q_session_snapshot,
        "wau_users": q_wau_users,
        "wau_users_range": q_wau_users_range,
        "wau_users_to": q_wau_users_to,
        "weekly_active_sessions": q_weekly_active_sessions,
        "weekly_active_sessions_range": q_weekly_active_sessions_range,
        "weekly_active_sessions_from": q_weekly_active_sessions_from,
        "wau_users_sql": q_wau_users_sql,
        "weekly_active_sessions_sql": q_weekly_active_sessions_sql,
        "unique_sessions": q_unique_sessions,
        "output_partitions": q_output_partitions,
        "output_partition_summary": q_output_partition_summary,
        "affected_weeks": q_affected_weeks,
        "dlq_ratio": q_dlq_ratio,
        "stage_counts": q_stage_counts,
        "input_profile": q_input_profile,
        "wau_summary": q_wau_summary,
        **WRITING_QUERIES,
    }


# ----------------------------------------------------------------------------
# Queries that write and read back (each under a new folder of the shared dir)
# ----------------------------------------------------------------------------
def q_quality_gate(spark, sf_dir):
    from activitykit.functions.reasons import is_invalid
    from activitykit.operators.dedup import with_dedup_key
    from activitykit.plans.quality import gate_of_metrics

    keyed = with_dedup_key(normalized(spark, sf_dir))
    metrics = keyed.agg(
        F.count(F.lit(1)).alias("input_row_count"),
        F.count_distinct(F.when(~is_invalid(), F.col("dedup_key"))).alias("output_row_count"),
        F.count_if(F.col("event_time_utc").isNull()).alias("invalid_event_time_count"),
        (F.count_if(is_invalid()).cast("double") / F.count(F.lit(1)).cast("double")).alias("dlq_ratio"),
    )
    return gate_of_metrics(metrics)


def q_csv_scan(spark, sf_dir):
    from activitykit.runtime import scratch_path
    from activitykit.sources.activity_csv import read_activity_csv, write_activity_csv

    path = scratch_path(spark, "csv")
    ensure_utc(spark)
    write_activity_csv(events_as_activity(spark, sf_dir, dirty=True), path)
    return comparable(normalize(read_activity_csv(spark, path), RUN_ID))


def q_malformed_lines(spark, sf_dir):
    """Every line that does not fit the schema, at its byte place, with its dead letter (none where only the price is bad)."""
    from activitykit.runtime import scratch_path
    from activitykit.sources.activity_csv import malformed_lines, read_activity_csv, write_activity_csv
    from activitykit.sources.events import events_as_text_activity

    path = scratch_path(spark, "malformed-csv")
    ensure_utc(spark)
    write_activity_csv(events_as_text_activity(spark, sf_dir), path)
    dead = validate(normalize(read_activity_csv(spark, path, keep_malformed=True), RUN_ID), TARGET_DATE).invalid
    letters = dead.select(
        "reject_reason",
        F.get_json_object("raw_payload", "$.malformed_line").alias("malformed_line"),
        F.get_json_object("raw_payload", "$.source_file").alias("source_file"),
        F.get_json_object("raw_payload", "$.source_block_start").cast("bigint").alias("_block"),
    )
    found = malformed_lines(spark, path).join(letters, ["source_file", "malformed_line"], "left")
    return found.select("malformed_line", "reject_reason", (F.col("byte_offset") >= F.col("_block")).alias("in_block"))


def _table_rows(df: DataFrame) -> DataFrame:
    return comparable(df.select("raw_user_session", "session_id", "price", "event_time_utc", "event_date_kst"))


def q_publish_roundtrip(spark, sf_dir):
    from activitykit.runtime import scratch_path
    from activitykit.sources import fs
    from activitykit.sources.publish import publish_partitions
    from activitykit.sources.sinks import to_table_layout, write_staging

    root = scratch_path(spark, "publish")
    write_staging(to_table_layout(sessionized(spark, sf_dir)), f"{root}/staging")
    dates = [d.split("=", 1)[1] for d in fs.list_dirs(spark, f"{root}/staging")]
    publish_partitions(spark, f"{root}/staging", f"{root}/final", dates)
    return _table_rows(spark.read.parquet(f"{root}/final"))


def q_catalog_roundtrip(spark, sf_dir):
    import uuid

    from activitykit.runtime import scratch_path
    from activitykit.sources import catalog, fs
    from activitykit.sources.publish import publish_partitions
    from activitykit.sources.sinks import to_table_layout, write_staging

    root = scratch_path(spark, "catalog")
    write_staging(to_table_layout(sessionized(spark, sf_dir)), f"{root}/staging")
    dates = [d.split("=", 1)[1] for d in fs.list_dirs(spark, f"{root}/staging")]
    publish_partitions(spark, f"{root}/staging", f"{root}/final", dates, move=True)
    name = f"activity_events_{uuid.uuid4().hex[:12]}"
    catalog.create_activity_table(spark, name, f"{root}/final")
    catalog.add_partitions(spark, name, f"{root}/final", dates)
    return comparable(weekly_users(catalog.read_table(spark, name)))


def q_versioned_publish(spark, sf_dir):
    """Three versions of the table: all days without their rows' prices, then the days of each half whole; read by
    the last manifest on one half and by the re-pointed catalog table on the other."""
    import uuid

    from activitykit.runtime import scratch_path
    from activitykit.sources import catalog, versions
    from activitykit.sources.sinks import to_table_layout, write_staging

    base, name = scratch_path(spark, "versions"), f"activity_events_{uuid.uuid4().hex[:12]}"
    write_staging(to_table_layout(sessionized(spark, sf_dir)), f"{base}-all")
    rows = spark.read.parquet(f"{base}-all")
    early = F.col("event_date_kst") <= F.lit(FIRST_BATCH_END).cast("date")
    catalog.create_activity_table(spark, name, base)
    for version, part in [("bare", rows.withColumn("price", F.lit(None).cast("decimal(18,2)"))), ("early", rows.where(early)), ("late", rows.where(~early))]:
        write_staging(part, versions.version_path(base, version))
        versions.publish_version(spark, base, version, table=name)
    return _table_rows(versions.read_current(spark, base).where(early).unionByName(catalog.read_table(spark, name).where(~early)))


def q_forward_repair(spark, sf_dir):
    """Two runs, the first without every third event; then the first range again with all. The later days follow."""
    from activitykit.plans.batch import run_batch
    from activitykit.runtime import scratch_path
    from activitykit.sources.versions import read_current

    root = scratch_path(spark, "repair")
    raw = events_as_activity(spark, sf_dir, dirty=True)
    first, second = _run_ranges(spark, sf_dir)
    in_first = F.col("event_time") < f"{FIRST_BATCH_END} 15:00:00"  # midnight KST, in UTC
    some = raw.where(~F.coalesce(in_first & (F.pmod(F.xxhash64("user_session"), F.lit(3)) == 0), F.lit(False)))
    run_batch(spark, _batch_config(root, "part", *first), some)
    run_batch(spark, _batch_config(root, "rest", *second), some)
    run_batch(spark, _batch_config(root, "late", *first), raw)
    return _table_rows(read_current(spark, f"{root}/final"))


def _merged_weekly(spark, sf_dir, metric, name):
    """Day bitmaps extended by two ranges of days, the first once more; weeks merged from bitmaps."""
    from activitykit.operators.weekly_state import WeeklyState
    from activitykit.runtime import scratch_path
    from activitykit.sources.sinks import to_table_layout, write_staging

    root = scratch_path(spark, name)
    write_staging(to_table_layout(sessionized(spark, sf_dir)), f"{root}/table")
    table = spark.read.parquet(f"{root}/table")
    state = WeeklyState(spark, f"{root}/state", metric)
    first, second = _run_ranges(spark, sf_dir)
    for lo, hi in (first, second, first):
        state.update(filter_kst_range(table, lo, hi), [])
    return comparable(state.counts())


def q_wau_users_bitmaps(spark, sf_dir):
    from activitykit.operators.weekly_state import USERS

    return _merged_weekly(spark, sf_dir, USERS, "user-bitmaps")


def q_weekly_active_sessions_bitmaps(spark, sf_dir):
    from activitykit.operators.weekly_state import SESSIONS

    return _merged_weekly(spark, sf_dir, SESSIONS, "session-bitmaps")


def _run_ranges(spark, sf_dir) -> list[tuple[str, str]]:
    """Two runs that cover all days of the table (its first and last day are one aggregate row)."""
    day = F.to_date(to_kst(F.col("ts").cast("timestamp")))
    first, last = read_events(spark, sf_dir).agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
    return [(min(first, FIRST_BATCH_END), FIRST_BATCH_END), (SECOND_BATCH_START, max(last, SECOND_BATCH_START))]


def q_incremental_weekly_overwrite(spark, sf_dir):
    """Two runs; the second recomputes only its weeks from the table and rewrites
    only those week partitions. The dataset read back covers all weeks."""
    from activitykit.functions.time import monday_of
    from activitykit.runtime import scratch_path
    from activitykit.sources import fs
    from activitykit.sources.publish import publish_partitions
    from activitykit.sources.sinks import to_table_layout, write_staging, write_weekly

    root = scratch_path(spark, "weekly")
    valid = valid_invalid(spark, sf_dir).valid
    snapshot = None
    for i, (lo, hi) in enumerate(_run_ranges(spark, sf_dir)):
        sess = _sessionize_valid(spark, sf_dir, filter_kst_range(valid, lo, hi), SEEDED_GAP_SECONDS, snapshot)
        write_staging(to_table_layout(sess), f"{root}/staging-{i}")
        dates = [d.split("=", 1)[1] for d in fs.list_dirs(spark, f"{root}/staging-{i}")]
        publish_partitions(spark, f"{root}/staging-{i}", f"{root}/final", dates, move=True)
        table = spark.read.parquet(f"{root}/final")
        write_weekly(weekly_sessions(table, monday_of(lo), monday_of(hi)), f"{root}/weekly")
        snapshot = build_snapshot(filter_kst_range(table, lo, hi), hi, RUN_ID)
    return comparable(spark.read.parquet(f"{root}/weekly").select("week_start_kst", "weekly_active_sessions"))


def _batch_config(root, run_id, lo, hi):
    from activitykit.plans.batch import BatchConfig

    tag = root.rsplit("-", 1)[1][:12]
    return BatchConfig(
        start_date=lo,
        end_date=hi,
        run_id=run_id,
        output_base_path=f"{root}/final",
        staging_base_path=f"{root}/staging",
        dlq_base_path=f"{root}/dlq",
        session_state_base_path=f"{root}/state",
        run_log_base_path=f"{root}/log",
        wau_output_base_path=f"{root}/wau",
        table_name=f"activity_events_{tag}",
        wau_users_table=f"wau_users_by_week_{tag}",
        weekly_sessions_table=f"weekly_active_sessions_by_week_{tag}",
        gap_seconds=SEEDED_GAP_SECONDS,
    )


def _two_batch_runs(spark, sf_dir, name):
    from activitykit.plans.batch import run_batch
    from activitykit.runtime import scratch_path

    root = scratch_path(spark, name)
    raw = events_as_activity(spark, sf_dir, dirty=True)
    results = []
    for i, (lo, hi) in enumerate(_run_ranges(spark, sf_dir)):
        results.append(run_batch(spark, _batch_config(root, f"run-{i}", lo, hi), raw))
    return root, results


def q_run_log_phases(spark, sf_dir):
    """The records of a run that succeeds and of one that the quality gate stops, in phase order."""
    from activitykit.plans.batch import run_batch
    from activitykit.plans.quality import QualityGateError
    from activitykit.plans.run_log import read_run_log
    from activitykit.runtime import scratch_path

    root = scratch_path(spark, "run-log")
    raw = events_as_activity(spark, sf_dir, dirty=True)
    (lo, _), (_, hi) = _run_ranges(spark, sf_dir)
    run_batch(spark, _batch_config(root, "good", lo, hi), raw)
    try:
        run_batch(spark, _batch_config(root, "stopped", lo, hi), raw.withColumn("event_time", F.lit("bad-time")))
    except QualityGateError:
        pass
    logs = [read_run_log(spark, f"{root}/log", run) for run in ("good", "stopped")]
    return logs[0].unionByName(logs[1]).select("run_id", "seq", "status", "input_row_count")


def q_run_history(spark, sf_dir):
    """Reject reasons of two runs and the number of their records, from the log table; the first run is compacted before the second."""
    from activitykit.plans.batch import run_batch
    from activitykit.plans.run_log import compact_history, read_history
    from activitykit.runtime import scratch_path

    root = scratch_path(spark, "run-history")
    raw = events_as_activity(spark, sf_dir, dirty=True)
    for i, (lo, hi) in enumerate(_run_ranges(spark, sf_dir)):
        run_batch(spark, _batch_config(root, f"run-{i}", lo, hi), raw)
        if i == 0:
            compact_history(spark, f"{root}/log")
    history = read_history(spark, f"{root}/log")
    records = history.groupBy("run_id").agg(F.count(F.lit(1)).alias("record_count"))
    reasons = history.where(F.col("status") == "SUCCESS").select("run_id", F.explode("invalid_reason_summary").alias("reject_reason", "row_count"))
    return reasons.join(records, "run_id")


def q_snapshot_roundtrip(spark, sf_dir):
    """The first run's state is saved, loaded and continued, at a gap that sessions of many users cross."""
    from activitykit.runtime import scratch_path
    from activitykit.sources.snapshot_store import load_snapshot, save_snapshot

    base = scratch_path(spark, "state")
    first = _first_batch(spark, sf_dir, SEEDED_GAP_SECONDS)
    save_snapshot(build_snapshot(first, FIRST_BATCH_END, RUN_ID), base, FIRST_BATCH_END)
    second = _second_batch(spark, sf_dir, SEEDED_GAP_SECONDS, load_snapshot(spark, base, FIRST_BATCH_END))
    return _session_rows(first.unionByName(second))


def q_dlq_roundtrip(spark, sf_dir):
    from activitykit.runtime import scratch_path
    from activitykit.sources.sinks import write_dlq

    path = scratch_path(spark, "dlq")
    write_dlq(valid_invalid(spark, sf_dir).invalid, path)
    return comparable(spark.read.parquet(path))


def q_weekly_table_roundtrip(spark, sf_dir):
    """Weeks registered at a folder of zeros, then re-pointed at the results, read through the table."""
    import uuid

    from activitykit.runtime import scratch_path
    from activitykit.sources import catalog, fs
    from activitykit.sources.sinks import write_weekly

    root = scratch_path(spark, "weekly-table")
    write_weekly(weekly_sessions(sessionized(spark, sf_dir)), f"{root}/new")
    write_weekly(spark.read.parquet(f"{root}/new").withColumn("weekly_active_sessions", F.lit(0).cast("long")), f"{root}/old")
    weeks = [d.split("=", 1)[1] for d in fs.list_dirs(spark, f"{root}/new") if "=" in d]
    name = f"weekly_active_sessions_{uuid.uuid4().hex[:12]}"
    catalog.create_weekly_table(spark, name, "weekly_active_sessions", f"{root}/old")
    catalog.add_week_partitions(spark, name, f"{root}/old", weeks)
    catalog.add_week_partitions(spark, name, f"{root}/new", weeks)
    return comparable(catalog.read_table(spark, name).select("week_start_kst", "weekly_active_sessions"))


def q_batch_weekly_sessions(spark, sf_dir):
    root, _ = _two_batch_runs(spark, sf_dir, "batch-sessions")
    path = f"{root}/wau/weekly-active-sessions-by-week"
    return comparable(spark.read.parquet(path).select("week_start_kst", "weekly_active_sessions"))


def q_batch_run_metrics(spark, sf_dir):
    from activitykit.plans.run_log import read_run_log

    root, _ = _two_batch_runs(spark, sf_dir, "batch-metrics")
    logs = [read_run_log(spark, f"{root}/log", f"run-{i}").where(F.col("status") == "SUCCESS") for i in (0, 1)]
    return logs[0].unionByName(logs[1]).select(
        "run_id",
        "input_row_count",
        "valid_row_count",
        "invalid_row_count",
        "out_of_range_row_count",
        "output_row_count",
        "duplicate_group_count",
        "duplicate_rows_count",
        "dropped_duplicate_rows_count",
        "unique_session_count",
        "output_partition_count",
        "output_partition_start",
        "output_partition_end",
    )


def q_duplicate_groups_export(spark, sf_dir):
    from activitykit.runtime import scratch_path
    from activitykit.sources.sinks import export_duplicate_groups

    path = scratch_path(spark, "groups-json")
    export_duplicate_groups(deduplicate(valid_invalid(spark, sf_dir).valid).duplicate_groups, path)
    return spark.read.schema(
        "dedup_key string, duplicate_group_size long, dropped_duplicate_row_count long"
    ).json(path)


def q_snapshot_export(spark, sf_dir):
    from activitykit.runtime import scratch_path
    from activitykit.schema import SNAPSHOT_SCHEMA
    from activitykit.sources.sinks import export_snapshot

    path = scratch_path(spark, "snapshot-json")
    export_snapshot(build_snapshot(sessionized(spark, sf_dir), "2024-01-31", RUN_ID), path)
    return comparable(spark.read.schema(SNAPSHOT_SCHEMA).json(path))


STREAM_CHUNK_ENDS = ["2024-01-08", "2024-01-16", "2024-01-24", "9999-12-31"]


def q_streaming_sessions(spark, sf_dir):
    """The events arrive in four time-ordered drops; after each drop the stream
    processes what is new (availableNow), continuing sessions through its state."""
    from activitykit.functions.time import parse_event_time, to_kst
    from activitykit.runtime import scratch_path
    from activitykit.schema import RAW_SCHEMA
    from activitykit.streaming import StreamConfig, read_sessions, start_incremental_sessions

    ensure_utc(spark)
    root = scratch_path(spark, "stream")
    raw = events_as_activity(spark, sf_dir, dirty=True)
    day = F.coalesce(F.to_date(to_kst(parse_event_time("event_time"))), F.lit("0001-01-01").cast("date"))
    cfg = StreamConfig(f"{root}/out", f"{root}/state", f"{root}/dlq", run_id=RUN_ID,
                       fallback_target_date=TARGET_DATE, gap_seconds=SEEDED_GAP_SECONDS)
    lo = "0001-01-01"
    for hi in STREAM_CHUNK_ENDS:
        cond = day.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")) if lo == "0001-01-01" else (
            (day > F.lit(lo).cast("date")) & (day <= F.lit(hi).cast("date")))
        raw.where(cond).write.mode("append").parquet(f"{root}/src")
        stream = spark.readStream.schema(RAW_SCHEMA).parquet(f"{root}/src")
        start_incremental_sessions(stream, cfg, f"{root}/checkpoint", available_now=True).awaitTermination()
        lo = hi
    return _session_rows(read_sessions(spark, f"{root}/out"))


WRITING_QUERIES = {
    "streaming_sessions": q_streaming_sessions,
    "quality_gate": q_quality_gate,
    "run_log_phases": q_run_log_phases,
    "run_history": q_run_history,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "dlq_roundtrip": q_dlq_roundtrip,
    "weekly_table_roundtrip": q_weekly_table_roundtrip,
    "csv_scan": q_csv_scan,
    "malformed_lines": q_malformed_lines,
    "publish_roundtrip": q_publish_roundtrip,
    "catalog_roundtrip": q_catalog_roundtrip,
    "incremental_weekly_overwrite": q_incremental_weekly_overwrite,
    "batch_weekly_sessions": q_batch_weekly_sessions,
    "batch_run_metrics": q_batch_run_metrics,
    "duplicate_groups_export": q_duplicate_groups_export,
    "snapshot_export": q_snapshot_export,
    "versioned_publish": q_versioned_publish,
    "forward_repair": q_forward_repair,
    "wau_users_bitmaps": q_wau_users_bitmaps,
    "weekly_active_sessions_bitmaps": q_weekly_active_sessions_bitmaps,
}
