"""DataFrame → DataFrame operators of the activity pipeline."""

from activitykit.operators.dedup import (
    DeduplicationResult,
    deduplicate,
    duplicate_groups_of,
    duplicate_metrics,
    with_dedup_key,
)
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
from activitykit.operators.session_number import numbered_sessions, with_session_number
from activitykit.operators.sessionize import (
    first_event_per_user,
    sessionize,
    user_activity_stats,
)
from activitykit.operators.snapshot import build_snapshot
from activitykit.operators.validate import ValidationResult, filter_kst_range, validate
from activitykit.operators.weekly import (
    affected_weeks,
    affected_weeks_of,
    week_filter,
    weekly_sessions,
    weekly_sessions_sql,
    weekly_summary,
    weekly_users,
    weekly_users_sql,
    with_all_weeks,
)

__all__ = [
    "DeduplicationResult",
    "ValidationResult",
    "affected_weeks",
    "affected_weeks_of",
    "build_snapshot",
    "deduplicate",
    "dlq_ratio",
    "duplicate_groups_of",
    "duplicate_metrics",
    "filter_kst_range",
    "first_event_per_user",
    "normalize",
    "numbered_sessions",
    "output_partition_summary",
    "output_partitions",
    "reason_display",
    "reason_histogram",
    "sessionize",
    "stage_counts",
    "unique_sessions",
    "user_activity_stats",
    "validate",
    "week_filter",
    "weekly_sessions",
    "weekly_sessions_sql",
    "weekly_summary",
    "weekly_users",
    "weekly_users_sql",
    "with_all_weeks",
    "with_dedup_key",
    "with_session_number",
]
