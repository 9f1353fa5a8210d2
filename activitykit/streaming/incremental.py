"""The incremental path as a Structured Streaming query.

Each micro-batch is one run of the pipeline on the rows that arrived: normalize →
validate (dead-letter) → dedup within the batch → sessionize seeded by the
per-user state of the previous batches → published rows; then the state is
advanced. This is the reference's "next run continues the sessions of the last
one", with the stream's checkpoint replacing the run bookkeeping.

Exactly-once: every output of micro-batch N (rows, dead-letter rows, state) is
written with overwrite to a folder named ``batch_id=N``, and batch N reads the
state of the newest batch before N. A retried batch therefore rewrites the same
folders from the same inputs instead of appending twice.

State: one row per user ever seen (last event time, last session start and id),
kept in ``<state>/batch_id=N``. The next state is the batch's snapshot plus the
previous state, of which each user's greatest last event stays: a user idle for
several batches still continues correctly when the gap allows it, and late rows
(older than a user's state) open a new session without setting the state back. Only the two newest states are kept.
With ``state_retention_seconds`` users whose last event lies that far behind the newest event of all
leave the state, so it holds the recently active ones; rows that come later than that (no less than
the gap) open a new session.

Output accumulates one folder per micro-batch; a long-running stream needs the
usual periodic compaction of its small files, which is outside this module.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from activitykit.operators.dedup import deduplicate
from activitykit.operators.normalize import normalize
from activitykit.operators.sessionize import (
    DEFAULT_MAX_USER_ROWS,
    sessionize,
    user_activity_stats,
)
from activitykit.operators.snapshot import build_snapshot, latest_state_per_user
from activitykit.operators.validate import validate
from activitykit.plans.preflight import today_kst
from activitykit.runtime import ensure_utc
from activitykit.schema import SESSION_GAP_SECONDS
from activitykit.sources import fs
from activitykit.sources.sinks import to_table_layout


@dataclass
class StreamConfig:
    output_path: str
    state_path: str
    dlq_path: str
    run_id: str = "stream"
    gap_seconds: int = SESSION_GAP_SECONDS
    max_user_rows: int | None = DEFAULT_MAX_USER_ROWS
    fallback_target_date: str | None = None  # DLQ date of unparsable rows; default: today in KST
    state_retention_seconds: int | None = None  # None: users stay in the state for ever

    def __post_init__(self):
        if self.state_retention_seconds is not None and self.state_retention_seconds < self.gap_seconds:
            raise ValueError(f"state_retention_seconds must not be below gap_seconds: {self.state_retention_seconds}")


def _batch_dir(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/batch_id={batch_id}"


def _latest_state_id(spark: SparkSession, state_path: str, before: int) -> int | None:
    ids = [int(d.split("=", 1)[1]) for d in fs.list_dirs(spark, state_path) if d.startswith("batch_id=")]
    ids = [i for i in ids if i < before and fs.exists(spark, f"{_batch_dir(state_path, i)}/_SUCCESS")]
    return max(ids) if ids else None


def latest_state(spark: SparkSession, state_path: str, before: int) -> DataFrame | None:
    """State written by the newest micro-batch before ``before`` (None at the start)."""
    state_id = _latest_state_id(spark, state_path, before)
    return None if state_id is None else spark.read.parquet(_batch_dir(state_path, state_id))


def process_micro_batch(batch: DataFrame, batch_id: int, cfg: StreamConfig) -> None:
    spark = batch.sparkSession
    ensure_utc(spark)
    if batch.isEmpty():
        return
    run_id = f"{cfg.run_id}-{batch_id}"
    normalized = normalize(batch, run_id)
    valid, invalid = validate(normalized, cfg.fallback_target_date or today_kst().isoformat())
    invalid.write.mode("overwrite").partitionBy("target_date").parquet(_batch_dir(cfg.dlq_path, batch_id))

    previous_id = _latest_state_id(spark, cfg.state_path, batch_id)
    previous = None if previous_id is None else spark.read.parquet(_batch_dir(cfg.state_path, previous_id))
    sess = sessionize(
        deduplicate(valid).deduplicated,
        previous,
        gap_seconds=cfg.gap_seconds,
        max_user_rows=cfg.max_user_rows,
        user_stats=user_activity_stats(valid) if cfg.max_user_rows is not None else None,
    )
    out = _batch_dir(cfg.output_path, batch_id)
    rows = to_table_layout(sess)
    rows.hint("rebalance", "event_date_kst").write.mode("overwrite").partitionBy("event_date_kst").parquet(out)

    # Advance the state from the rows just written (no recomputation of the batch). The schema is
    # given: a batch of invalid rows alone leaves no file to infer one from.
    written = spark.read.schema(rows.schema).parquet(out)
    snapshot = build_snapshot(written, today_kst().isoformat(), run_id)
    if previous is not None:
        snapshot = latest_state_per_user(snapshot, previous)
    if cfg.state_retention_seconds is not None:
        both = written.select("event_time_utc") if previous is None else written.select("event_time_utc").unionAll(previous.select("last_event_time_utc"))
        newest = both.agg(F.max("event_time_utc")).first()[0]
        kept_for = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(cfg.state_retention_seconds))
        snapshot = snapshot.where(F.col("last_event_time_utc") > F.lit(newest) - kept_for)
    snapshot.write.mode("overwrite").parquet(_batch_dir(cfg.state_path, batch_id))
    # Keep the state this batch read (a retry reads it again) and the new one.
    if previous_id is not None:
        for d in fs.list_dirs(spark, cfg.state_path):
            if d.startswith("batch_id=") and int(d.split("=", 1)[1]) < previous_id:
                fs.delete(spark, f"{cfg.state_path.rstrip('/')}/{d}")


def start_incremental_sessions(
    stream: DataFrame,
    cfg: StreamConfig,
    checkpoint_path: str,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Starts the query on a streaming DataFrame of raw rows."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(
        lambda df, batch_id: process_micro_batch(df, batch_id, cfg)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_sessions(spark: SparkSession, output_path: str) -> DataFrame:
    """All published rows of all micro-batches (partition columns batch_id, event_date_kst)."""
    return spark.read.parquet(output_path)
