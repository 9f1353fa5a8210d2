"""Schemas and fixed values of the activity pipeline.

Every stage is a plain DataFrame; the schemas below are the contract between
stages (raw input, normalized, dead-letter, deduplicated, sessionized,
snapshot, published table, weekly aggregates, run log).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written: they decide parse results,
# hash ids, reject codes and the partition layout that other runs read back.
# ---------------------------------------------------------------------------
EVENT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss 'UTC'"
KST_ZONE = "Asia/Seoul"
WEEK_START_DAY = "MON"
SESSION_GAP_SECONDS = 300
PRICE_TYPE = T.DecimalType(18, 2)
NULL_TOKEN = "__null__"
KEY_SEPARATOR = "||"
REASON_SEPARATOR = "|"
REASON_INVALID_EVENT_TIME = "INVALID_EVENT_TIME"
REASON_NULL_USER_ID = "NULL_USER_ID"
REASON_NULL_EVENT_TYPE = "NULL_EVENT_TYPE"
REASON_NULL_PRODUCT_ID = "NULL_PRODUCT_ID"
REASON_NEGATIVE_PRICE = "NEGATIVE_PRICE"
DLQ_WARN_RATIO = 0.01
DLQ_FAIL_RATIO = 0.05
PROMOTE_BACKUP_DIR = ".promote-backup"
PROMOTE_WORK_DIR = ".promote-work"
DEFAULT_PROMOTE_RETRIES = 3
# Status names written to the run log, in phase order.
STATUS_RUNNING = "RUNNING"
STATUS_NORMALIZING = "NORMALIZING"
STATUS_VALIDATING = "VALIDATING"
STATUS_DEDUPLICATING = "DEDUPLICATING"
STATUS_SESSIONIZING = "SESSIONIZING"
STATUS_PROMOTING = "PROMOTING"
STATUS_REGISTERING = "REGISTERING_HIVE"
STATUS_COMPUTING_WAU = "COMPUTING_WAU"
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED = "FAILED"
# Quality-gate messages (a failing or warning ratio follows, with four decimals).
GATE_INPUT_EMPTY = "input_row_count must be greater than 0"
GATE_OUTPUT_EMPTY = "output_row_count must be greater than 0"
GATE_ALL_BAD_TIME = "all rows failed event_time parsing"
GATE_RATIO_FAIL_PREFIX = "dlq_ratio must be <= 0.05 but was "
GATE_RATIO_WARN_PREFIX = "dlq_ratio warning: "
# Default table names.
ACTIVITY_TABLE = "activity_events"
WAU_USERS_TABLE = "wau_users_by_week"
WEEKLY_SESSIONS_TABLE = "weekly_active_sessions_by_week"
# ---------------------------------------------------------------------------

# Raw click-stream row, all nullable, read by position with this schema.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

# Fields copied into the dead-letter raw payload, in payload order.
RAW_PAYLOAD_FIELDS = [
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "raw_user_session",
]

# Kept beside the raw row when a CSV line does not fit the schema; payload fields of its dead letter.
MALFORMED_LINE = "malformed_line"
SOURCE_FILE = "source_file"
SOURCE_BLOCK_START = "source_block_start"
MALFORMED_FIELDS = [MALFORMED_LINE, SOURCE_FILE, SOURCE_BLOCK_START]

# Order of the session window; also the tie-breaker of the snapshot pick.
SESSION_ORDER = ["event_time_utc", "product_id", "event_type", "dedup_key"]

# S1 columns added by normalization (after the raw ones, user_session renamed).
NORMALIZED_COLUMNS = [
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "raw_user_session",
    "event_time_utc",
    "event_time_kst",
    "event_date_kst",
    "week_start_kst",
    "normalized_price",
    "ingested_at",
    "run_id",
]

SESSION_COLUMNS = [
    "session_start_time_utc",
    "session_start_time_kst",
    "session_start_week_kst",
    "session_id",
]

# One row per user, the state a later run continues from.
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_date_kst", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("last_session_id", T.StringType()),
        T.StructField("last_session_start_time_utc", T.TimestampType()),
        T.StructField("last_event_time_utc", T.TimestampType()),
        T.StructField("last_event_time_kst", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)

# Published activity table; partition column last.
ACTIVITY_TABLE_COLUMNS = [
    ("event_time_utc", "timestamp"),
    ("event_time_kst", "timestamp"),
    ("event_type", "string"),
    ("product_id", "bigint"),
    ("category_id", "bigint"),
    ("category_code", "string"),
    ("brand", "string"),
    ("price", "decimal(18,2)"),
    ("user_id", "bigint"),
    ("raw_user_session", "string"),
    ("week_start_kst", "date"),
    ("dedup_key", "string"),
    ("session_id", "string"),
    ("session_start_time_utc", "timestamp"),
    ("session_start_time_kst", "timestamp"),
    ("session_start_week_kst", "date"),
    ("ingested_at", "timestamp"),
    ("run_id", "string"),
    ("event_date_kst", "date"),
]

# Run-log record; optional fields are NULL and omitted from the JSON text.
RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("target_date", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.StringType(), False),
        T.StructField("updated_at", T.StringType(), False),
        T.StructField("seq", T.IntegerType(), False),
        T.StructField("message", T.StringType()),
        T.StructField("staging_path", T.StringType()),
        T.StructField("dlq_path", T.StringType()),
        T.StructField("final_output_path", T.StringType()),
        T.StructField("processing_start_date", T.StringType()),
        T.StructField("processing_end_date", T.StringType()),
        T.StructField("snapshot_seed_date", T.StringType()),
        T.StructField("snapshot_target_date", T.StringType()),
        T.StructField("quality_gate_warnings", T.ArrayType(T.StringType())),
        T.StructField("input_row_count", T.LongType()),
        T.StructField("valid_row_count", T.LongType()),
        T.StructField("invalid_row_count", T.LongType()),
        T.StructField("out_of_range_row_count", T.LongType()),
        T.StructField("output_row_count", T.LongType()),
        T.StructField("duplicate_group_count", T.LongType()),
        T.StructField("duplicate_rows_count", T.LongType()),
        T.StructField("dropped_duplicate_rows_count", T.LongType()),
        T.StructField("dlq_ratio", T.DoubleType()),
        T.StructField("invalid_reason_summary", T.MapType(T.StringType(), T.LongType())),
        T.StructField("output_partition_count", T.IntegerType()),
        T.StructField("output_partition_start", T.StringType()),
        T.StructField("output_partition_end", T.StringType()),
        T.StructField("unique_session_count", T.LongType()),
        T.StructField("registered_hive_partitions_count", T.IntegerType()),
        T.StructField("session_snapshot_path", T.StringType()),
        T.StructField("wau_users_output_path", T.StringType()),
        T.StructField("weekly_active_sessions_output_path", T.StringType()),
        T.StructField("wau_users_week_count", T.LongType()),
        T.StructField("wau_users_start_week", T.StringType()),
        T.StructField("wau_users_end_week", T.StringType()),
        T.StructField("weekly_active_sessions_week_count", T.LongType()),
        T.StructField("weekly_active_sessions_start_week", T.StringType()),
        T.StructField("weekly_active_sessions_end_week", T.StringType()),
    ]
)
