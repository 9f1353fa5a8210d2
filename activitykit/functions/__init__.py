"""Column-expression builders (all built-in Spark functions, JVM-side)."""

from activitykit.functions.keys import dedup_key, hash_key, key_part, session_id
from activitykit.functions.reasons import is_invalid, reject_reason, rule_columns
from activitykit.functions.time import (
    epoch_millis,
    epoch_seconds,
    monday_of,
    parse_event_time,
    to_kst,
    week_start,
)

__all__ = [
    "dedup_key",
    "epoch_millis",
    "epoch_seconds",
    "hash_key",
    "is_invalid",
    "key_part",
    "monday_of",
    "parse_event_time",
    "reject_reason",
    "rule_columns",
    "session_id",
    "to_kst",
    "week_start",
]
