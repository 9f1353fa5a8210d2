"""DuckDB SQL for every registered query, on the raw parquet views.

Written independently of the Spark code: plain window functions
(lag / running max / row_number) over the whole tables. Output columns and text
formats match ``activitykit.plans.registry.comparable``.
"""

from __future__ import annotations

from activitykit.plans.registry import (
    FIRST_BATCH_END,
    SECOND_BATCH_START,
    RANGE_END,
    RANGE_START,
    RUN_ID,
    SEEDED_GAP_SECONDS,
    TARGET_DATE,
    WEEK_FROM,
    WEEK_TO,
)

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _ts(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, {TS}) AS {alias or col}"


def _raw(dirty: bool) -> str:
    if not dirty:
        return """
raw0 AS (
  SELECT event_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS event_time,
    event_type,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS category_id,
    'cat.' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS category_code,
    CAST(NULL AS VARCHAR) AS brand,
    value AS price,
    user_id,
    CAST(event_id AS VARCHAR) AS user_session
  FROM events
),
raw AS (SELECT * EXCLUDE (event_id) FROM raw0)"""
    return """
raw0 AS (
  SELECT event_id,
    CASE WHEN event_id % 229 = 0 THEN 'bad-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S UTC') END AS event_time,
    CASE WHEN event_id % 223 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN event_id % 227 = 0 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS category_id,
    'cat.' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS category_code,
    CAST(NULL AS VARCHAR) AS brand,
    CASE WHEN event_id % 233 = 0 THEN -value ELSE value END AS price,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE user_id END AS user_id,
    CAST(event_id AS VARCHAR) AS user_session
  FROM events
),
raw AS (
  SELECT * EXCLUDE (event_id) FROM raw0
  UNION ALL
  SELECT * EXCLUDE (event_id) FROM raw0 WHERE event_id % 37 = 0
)"""


def _norm(dirty: bool = True) -> str:
    return _raw(dirty) + f""",
norm0 AS (
  SELECT event_time, event_type, product_id, category_id, category_code, brand, price, user_id,
    user_session AS raw_user_session,
    try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS event_time_utc
  FROM raw
),
norm AS (
  SELECT *,
    event_time_utc + INTERVAL 9 HOUR AS event_time_kst,
    CAST(event_time_utc + INTERVAL 9 HOUR AS DATE) AS event_date_kst,
    CAST(date_trunc('week', CAST(event_time_utc + INTERVAL 9 HOUR AS DATE)) AS DATE) AS week_start_kst,
    TRY_CAST(price AS DECIMAL(18,2)) AS normalized_price,
    '{RUN_ID}' AS run_id
  FROM norm0
),
flags AS (
  SELECT *,
    event_time_utc IS NULL AS r1,
    user_id IS NULL AS r2,
    event_type IS NULL AS r3,
    product_id IS NULL AS r4,
    coalesce(price < 0, false) AS r5
  FROM norm
),
valid AS (SELECT * EXCLUDE (r1, r2, r3, r4, r5) FROM flags WHERE NOT (r1 OR r2 OR r3 OR r4 OR r5)),
invalid AS (
  SELECT * EXCLUDE (r1, r2, r3, r4, r5),
    concat_ws('|',
      CASE WHEN r1 THEN 'INVALID_EVENT_TIME' END,
      CASE WHEN r2 THEN 'NULL_USER_ID' END,
      CASE WHEN r3 THEN 'NULL_EVENT_TYPE' END,
      CASE WHEN r4 THEN 'NULL_PRODUCT_ID' END,
      CASE WHEN r5 THEN 'NEGATIVE_PRICE' END) AS reject_reason,
    coalesce(CAST(event_date_kst AS VARCHAR), '{TARGET_DATE}') AS target_date
  FROM flags WHERE r1 OR r2 OR r3 OR r4 OR r5
)"""


def _key(col: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), '__null__')"


def _dedup_of(src: str, name: str) -> str:
    parts = ", ".join(
        _key(c)
        for c in [
            "user_id",
            "epoch_us(event_time_utc) // 1000",
            "event_type",
            "product_id",
            "category_id",
            "category_code",
            "brand",
            "normalized_price",
            "raw_user_session",
        ]
    )
    return f""",
{name}_keyed AS (SELECT *, sha256(concat_ws('||', {parts})) AS dedup_key FROM {src}),
{name}_ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY dedup_key
      ORDER BY price NULLS FIRST, event_time_utc NULLS FIRST, event_time NULLS FIRST) AS rn,
    count(*) OVER (PARTITION BY dedup_key) AS duplicate_group_size
  FROM {name}_keyed
),
{name} AS (SELECT * EXCLUDE (rn, duplicate_group_size) FROM {name}_ranked WHERE rn = 1)"""


ORDER = "event_time_utc, product_id, event_type, dedup_key"


def _sess_of(src: str, name: str, gap: int) -> str:
    return f""",
{name}_lag AS (
  SELECT *, lag(event_time_utc) OVER (PARTITION BY user_id ORDER BY {ORDER}) AS prev_t FROM {src}
),
{name}_flag AS (
  SELECT *,
    CASE WHEN prev_t IS NULL
      OR epoch(date_trunc('second', event_time_utc)) - epoch(date_trunc('second', prev_t)) >= {gap}
    THEN 1 ELSE 0 END AS is_new
  FROM {name}_lag
),
{name}_start AS (
  SELECT * EXCLUDE (prev_t, is_new),
    max(CASE WHEN is_new = 1 THEN event_time_utc END) OVER (PARTITION BY user_id ORDER BY {ORDER}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start_time_utc
  FROM {name}_flag
),
{name} AS (
  SELECT *,
    session_start_time_utc + INTERVAL 9 HOUR AS session_start_time_kst,
    CAST(date_trunc('week', CAST(session_start_time_utc + INTERVAL 9 HOUR AS DATE)) AS DATE) AS session_start_week_kst,
    sha256(CAST(user_id AS VARCHAR) || '||' || CAST(epoch_us(session_start_time_utc) // 1000 AS VARCHAR)) AS session_id
  FROM {name}_start
)"""


def pipeline(gap: int = 300) -> str:
    """CTEs raw → norm → valid/invalid → dedup → sess (dirty input)."""
    return "WITH " + _norm(True).lstrip() + _dedup_of("valid", "dedup") + _sess_of("dedup", "sess", gap)


NORM_COLS = [
    "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price",
    "user_id", "raw_user_session",
]


def _norm_select(extra: list[str] | None = None) -> str:
    cols = NORM_COLS + [
        _ts("event_time_utc"),
        _ts("event_time_kst"),
        "CAST(event_date_kst AS VARCHAR) AS event_date_kst",
        "CAST(week_start_kst AS VARCHAR) AS week_start_kst",
        "CAST(normalized_price AS VARCHAR) AS normalized_price",
        "run_id",
    ]
    return ", ".join(cols + (extra or []))


SESSION_ROW_SELECT = ", ".join(
    [
        "raw_user_session",
        "user_id",
        _ts("event_time_utc"),
        "dedup_key",
        "session_id",
        _ts("session_start_time_utc"),
        _ts("session_start_time_kst"),
        "CAST(session_start_week_kst AS VARCHAR) AS session_start_week_kst",
    ]
)


def _week_where(col: str, lo: str | None, hi: str | None) -> str:
    if lo and hi:
        return f"WHERE {col} BETWEEN DATE '{lo}' AND DATE '{hi}'"
    if lo:
        return f"WHERE {col} >= DATE '{lo}'"
    if hi:
        return f"WHERE {col} <= DATE '{hi}'"
    return ""


def _wau_users(lo=None, hi=None) -> str:
    return pipeline() + f"""
SELECT CAST(week_start_kst AS VARCHAR) AS week_start_kst, COUNT(DISTINCT user_id) AS wau_users
FROM sess {_week_where('week_start_kst', lo, hi)}
GROUP BY week_start_kst"""


def _weekly_sessions(lo=None, hi=None, gap: int = 300) -> str:
    return pipeline(gap) + f""",
sessions AS (SELECT DISTINCT session_id, session_start_week_kst AS week_start_kst FROM sess)
SELECT CAST(week_start_kst AS VARCHAR) AS week_start_kst, COUNT(*) AS weekly_active_sessions
FROM sessions {_week_where('week_start_kst', lo, hi)}
GROUP BY week_start_kst"""


def _raw_payload_sql() -> str:
    # JSON text of the nine raw fields, NULL fields left out, in field order.
    fields = [
        ("event_time", "to_json(event_time)"),
        ("event_type", "to_json(event_type)"),
        ("product_id", "CAST(product_id AS VARCHAR)"),
        ("category_id", "CAST(category_id AS VARCHAR)"),
        ("category_code", "to_json(category_code)"),
        ("brand", "to_json(brand)"),
        ("price", "to_json(price)"),
        ("user_id", "CAST(user_id AS VARCHAR)"),
        ("raw_user_session", "to_json(raw_user_session)"),
    ]
    parts = ", ".join(f"""CASE WHEN {f} IS NOT NULL THEN '"{f}":' || {expr} END""" for f, expr in fields)
    return "'{' || concat_ws(',', " + parts + ") || '}'"


def oracle() -> dict[str, str]:
    p = pipeline()
    q: dict[str, str] = {}
    q["normalize_events"] = "WITH " + _norm(False).lstrip() + f"\nSELECT {_norm_select()} FROM norm"
    q["valid_rows"] = "WITH " + _norm(True).lstrip() + f"\nSELECT {_norm_select()} FROM valid"
    q["invalid_rows"] = (
        "WITH " + _norm(True).lstrip() + f"\nSELECT {_norm_select(['reject_reason', 'target_date'])} FROM invalid"
    )
    q["raw_payload"] = (
        "WITH " + _norm(True).lstrip() + f"\nSELECT raw_user_session, {_raw_payload_sql()} AS raw_payload FROM invalid"
    )
    q["reject_reason_histogram"] = (
        "WITH " + _norm(True).lstrip() + '\nSELECT reject_reason, COUNT(*) AS "count" FROM invalid GROUP BY reject_reason'
    )
    q["reject_reason_top20"] = (
        "WITH "
        + _norm(True).lstrip()
        + '\nSELECT reject_reason, COUNT(*) AS "count" FROM invalid GROUP BY reject_reason'
        + ' ORDER BY "count" DESC, reject_reason LIMIT 20'
    )
    q["date_range_filter"] = (
        "WITH "
        + _norm(True).lstrip()
        + "\nSELECT raw_user_session, CAST(event_date_kst AS VARCHAR) AS event_date_kst FROM valid"
        + f" WHERE event_date_kst BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"
    )
    q["dedup_rows"] = p + f"\nSELECT {_norm_select(['dedup_key'])} FROM dedup"
    q["duplicate_groups"] = p + """
SELECT dedup_key, COUNT(*) AS duplicate_group_size, COUNT(*) - 1 AS dropped_duplicate_row_count
FROM dedup_keyed GROUP BY dedup_key HAVING COUNT(*) > 1"""
    q["duplicate_metrics"] = p + """,
groups AS (SELECT dedup_key, COUNT(*) AS n FROM dedup_keyed GROUP BY dedup_key HAVING COUNT(*) > 1)
SELECT COUNT(*) AS duplicate_group_count,
  CAST(coalesce(SUM(n), 0) AS BIGINT) AS duplicate_rows_count,
  CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS dropped_duplicate_rows_count
FROM groups"""
    for gap in (300, 1800, 3600):
        q[f"sessionize_{gap}"] = pipeline(gap) + f"\nSELECT {SESSION_ROW_SELECT} FROM sess"
    q["sessionize_hot_split"] = q["sessionize_300"]
    # Two seeded runs give the same sessions as one run over the whole range.
    q["sessionize_seeded"] = pipeline(SEEDED_GAP_SECONDS) + f"\nSELECT {SESSION_ROW_SELECT} FROM sess"
    q["sessionize_seeded_split"] = q["sessionize_seeded"]
    q["first_event_per_user"] = p + f"""
SELECT user_id, {_ts('min(event_time_utc)', 'first_event_time_utc')} FROM dedup GROUP BY user_id"""
    q["session_snapshot"] = p + f""",
last AS (
  SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY event_time_utc DESC, product_id DESC, event_type DESC, dedup_key DESC) AS rk
  FROM sess
)
SELECT '2024-01-31' AS snapshot_date_kst, user_id, session_id AS last_session_id,
  {_ts('session_start_time_utc', 'last_session_start_time_utc')},
  {_ts('event_time_utc', 'last_event_time_utc')},
  {_ts('event_time_kst', 'last_event_time_kst')},
  '{RUN_ID}' AS run_id
FROM last WHERE rk = 1"""
    q["session_numbers"] = pipeline(3600) + """
SELECT raw_user_session, user_id, session_id,
  dense_rank() OVER (PARTITION BY user_id ORDER BY session_start_time_utc) AS session_number
FROM sess"""
    q["malformed_lines"] = """
WITH lines AS (
  SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS event_time, event_type, user_id,
    CAST(TRY_CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS price
  FROM events
  WHERE event_id % 239 = 0 OR event_id % 241 = 0
)
SELECT concat_ws(',', event_time, event_type, CASE WHEN event_id % 239 = 0 THEN 'k' ELSE '' END || CAST(k AS VARCHAR),
    CAST(k % 10 AS VARCHAR), 'cat.' || CAST(k % 10 AS VARCHAR), '',
    CASE WHEN event_id % 241 = 0 THEN 'about ' ELSE '' END || price, CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR)) AS malformed_line,
  CASE WHEN event_id % 239 = 0 THEN 'NULL_PRODUCT_ID' END AS reject_reason,
  CASE WHEN event_id % 239 = 0 THEN true END AS in_block
FROM lines"""
    q["wau_users"] = _wau_users()
    q["wau_users_range"] = _wau_users(WEEK_FROM, WEEK_TO)
    q["wau_users_to"] = _wau_users(None, WEEK_TO)
    q["weekly_active_sessions"] = _weekly_sessions()
    q["weekly_active_sessions_range"] = _weekly_sessions(WEEK_FROM, WEEK_TO)
    q["weekly_active_sessions_from"] = _weekly_sessions(WEEK_FROM, None)
    q["unique_sessions"] = p + "\nSELECT COUNT(DISTINCT session_id) AS unique_session_count FROM sess"
    q["output_partitions"] = p + "\nSELECT DISTINCT CAST(event_date_kst AS VARCHAR) AS event_date_kst FROM sess"
    q["output_partition_summary"] = p + """
SELECT COUNT(DISTINCT event_date_kst) AS output_partition_count,
  CAST(MIN(event_date_kst) AS VARCHAR) AS output_partition_start,
  CAST(MAX(event_date_kst) AS VARCHAR) AS output_partition_end
FROM sess"""
    q["affected_weeks"] = "WITH " + _norm(False).lstrip() + """
SELECT CAST(CAST(w AS DATE) AS VARCHAR) AS week_start_kst
FROM (SELECT MIN(event_date_kst) AS s, MAX(event_date_kst) AS e FROM norm) b,
  LATERAL unnest(generate_series(date_trunc('week', b.s), date_trunc('week', b.e), INTERVAL 7 DAY)) AS t(w)"""
    q["dlq_ratio"] = "WITH " + _norm(True).lstrip() + """
SELECT COUNT(*) AS input_row_count,
  COUNT(*) FILTER (WHERE r1 OR r2 OR r3 OR r4 OR r5) AS invalid_row_count,
  CASE WHEN COUNT(*) = 0 THEN 0.0
    ELSE CAST(COUNT(*) FILTER (WHERE r1 OR r2 OR r3 OR r4 OR r5) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) END AS dlq_ratio
FROM flags"""
    q["stage_counts"] = p + """
SELECT 'input' AS stage, COUNT(*) AS row_count FROM norm
UNION ALL SELECT 'valid', COUNT(*) FROM valid
UNION ALL SELECT 'invalid', COUNT(*) FROM invalid
UNION ALL SELECT 'deduplicated', COUNT(*) FROM dedup
UNION ALL SELECT 'sessionized', COUNT(*) FROM sess"""
    q["wau_summary"] = p + """,
wu AS (SELECT week_start_kst FROM sess GROUP BY week_start_kst),
ws AS (SELECT session_start_week_kst AS week_start_kst FROM sess GROUP BY session_start_week_kst)
SELECT 'wau_users' AS result, COUNT(*) AS week_count,
  CAST(MIN(week_start_kst) AS VARCHAR) AS start_week, CAST(MAX(week_start_kst) AS VARCHAR) AS end_week FROM wu
UNION ALL
SELECT 'weekly_active_sessions', COUNT(*), CAST(MIN(week_start_kst) AS VARCHAR), CAST(MAX(week_start_kst) AS VARCHAR) FROM ws"""
    q["quality_gate"] = p + """,
m AS (
  SELECT COUNT(*) AS input_row_count,
    (SELECT COUNT(*) FROM dedup) AS output_row_count,
    COUNT(*) FILTER (WHERE r1) AS invalid_event_time_count,
    CAST(COUNT(*) FILTER (WHERE r1 OR r2 OR r3 OR r4 OR r5) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS dlq_ratio
  FROM flags
)
SELECT *,
  CASE WHEN input_row_count <= 0 OR output_row_count <= 0 OR invalid_event_time_count >= input_row_count
         OR dlq_ratio > 0.05 THEN 'FAIL'
       WHEN dlq_ratio > 0.01 THEN 'WARN' ELSE 'PASS' END AS gate_status,
  CASE WHEN input_row_count <= 0 THEN 'input_row_count must be greater than 0'
       WHEN output_row_count <= 0 THEN 'output_row_count must be greater than 0'
       WHEN invalid_event_time_count >= input_row_count THEN 'all rows failed event_time parsing'
       WHEN dlq_ratio > 0.05 THEN 'dlq_ratio must be <= 0.05 but was ' || printf('%.4f', dlq_ratio)
       WHEN dlq_ratio > 0.01 THEN 'dlq_ratio warning: ' || printf('%.4f', dlq_ratio) END AS gate_message
FROM m"""
    q["csv_scan"] = "WITH " + _norm(True).lstrip() + f"\nSELECT {_norm_select()} FROM norm"
    table_rows = ", ".join([
        "raw_user_session", "session_id", "CAST(normalized_price AS VARCHAR) AS price",
        _ts("event_time_utc"), "CAST(event_date_kst AS VARCHAR) AS event_date_kst",
    ])
    q["publish_roundtrip"] = p + f"\nSELECT {table_rows} FROM sess"
    q["catalog_roundtrip"] = q["wau_users"]
    q["versioned_publish"] = q["publish_roundtrip"]
    q["forward_repair"] = pipeline(SEEDED_GAP_SECONDS) + f"\nSELECT {table_rows} FROM sess"
    q["wau_users_bitmaps"] = q["wau_users"]
    q["weekly_active_sessions_bitmaps"] = q["weekly_active_sessions"]
    q["incremental_weekly_overwrite"] = _weekly_sessions(gap=SEEDED_GAP_SECONDS)
    q["batch_weekly_sessions"] = q["incremental_weekly_overwrite"]
    q["weekly_table_roundtrip"] = q["weekly_active_sessions"]
    q["snapshot_roundtrip"] = q["sessionize_seeded"]
    q["dlq_roundtrip"] = (
        "WITH " + _norm(True).lstrip()
        + f"\nSELECT {_norm_select(['reject_reason', 'target_date', _raw_payload_sql() + ' AS raw_payload'])} FROM invalid"
    )
    q["input_profile"] = "WITH " + _norm(True).lstrip() + f"""
SELECT CAST(event_date_kst AS VARCHAR) AS event_date_kst, COUNT(*) AS row_count,
  COUNT(*) FILTER (WHERE r1 OR r2 OR r3 OR r4 OR r5) AS invalid_count,
  COUNT(*) FILTER (WHERE NOT (r1 OR r2 OR r3 OR r4 OR r5)
    AND event_date_kst BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}') AS in_range_count
FROM flags GROUP BY event_date_kst"""
    q["run_log_phases"] = "WITH " + _norm(True).lstrip() + """
SELECT run_id, seq, status,
  CASE WHEN status IN ('DEDUPLICATING', 'SUCCESS') THEN (SELECT COUNT(*) FROM norm) END AS input_row_count
FROM (VALUES
  ('good', 1, 'RUNNING'), ('good', 2, 'NORMALIZING'), ('good', 3, 'VALIDATING'), ('good', 4, 'DEDUPLICATING'),
  ('good', 5, 'SESSIONIZING'), ('good', 6, 'PROMOTING'), ('good', 7, 'REGISTERING_HIVE'), ('good', 8, 'COMPUTING_WAU'),
  ('good', 9, 'SUCCESS'),
  ('stopped', 1, 'RUNNING'), ('stopped', 2, 'NORMALIZING'), ('stopped', 3, 'VALIDATING'),
  ('stopped', 4, 'DEDUPLICATING'), ('stopped', 5, 'SESSIONIZING'), ('stopped', 6, 'FAILED')) AS t(run_id, seq, status)"""
    q["run_history"] = "WITH " + _norm(True).lstrip() + """
SELECT r.run_id AS run_id, reject_reason, COUNT(*) AS row_count, CAST(9 AS BIGINT) AS record_count
FROM invalid, (VALUES ('run-0'), ('run-1')) AS r(run_id) GROUP BY r.run_id, reject_reason"""
    q["duplicate_groups_export"] = q["duplicate_groups"]
    q["snapshot_export"] = q["session_snapshot"]
    q["streaming_sessions"] = q["sessionize_seeded"]
    q["wau_users_sql"] = q["wau_users_range"]
    q["weekly_active_sessions_sql"] = q["weekly_active_sessions_range"]
    runs = []
    for i, rng in enumerate([f"event_date_kst <= DATE '{FIRST_BATCH_END}'", f"event_date_kst >= DATE '{SECOND_BATCH_START}'"]):
        runs.append(f"""
SELECT 'run-{i}' AS run_id,
  (SELECT COUNT(*) FROM norm) AS input_row_count,
  (SELECT COUNT(*) FROM valid WHERE {rng}) AS valid_row_count,
  (SELECT COUNT(*) FROM invalid) AS invalid_row_count,
  (SELECT COUNT(*) FROM norm) - (SELECT COUNT(*) FROM invalid) - (SELECT COUNT(*) FROM valid WHERE {rng})
    AS out_of_range_row_count,
  (SELECT COUNT(*) FROM sess WHERE {rng}) AS output_row_count,
  (SELECT COUNT(*) FROM (SELECT dedup_key FROM dedup_keyed WHERE {rng} GROUP BY dedup_key HAVING COUNT(*) > 1))
    AS duplicate_group_count,
  (SELECT CAST(coalesce(SUM(n), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM dedup_keyed WHERE {rng}
    GROUP BY dedup_key HAVING COUNT(*) > 1)) AS duplicate_rows_count,
  (SELECT CAST(coalesce(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM dedup_keyed WHERE {rng}
    GROUP BY dedup_key HAVING COUNT(*) > 1)) AS dropped_duplicate_rows_count,
  (SELECT COUNT(DISTINCT session_id) FROM sess WHERE {rng}) AS unique_session_count,
  (SELECT CAST(COUNT(DISTINCT event_date_kst) AS INTEGER) FROM sess WHERE {rng}) AS output_partition_count,
  (SELECT CAST(MIN(event_date_kst) AS VARCHAR) FROM sess WHERE {rng}) AS output_partition_start,
  (SELECT CAST(MAX(event_date_kst) AS VARCHAR) FROM sess WHERE {rng}) AS output_partition_end""")
    q["batch_run_metrics"] = pipeline(SEEDED_GAP_SECONDS) + "\n" + "\nUNION ALL".join(runs)
    return q
