"""Deterministic hash ids: the exact-duplicate key and the session id.

Both are SHA-256 hex over parts joined by ``||`` with NULL parts replaced by a
token, so a re-run, or a later run continuing a session, reproduces the id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activitykit.functions.time import epoch_millis
from activitykit.schema import KEY_SEPARATOR, NULL_TOKEN


def key_part(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(NULL_TOKEN))


def hash_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[key_part(p) for p in parts]), 256)


def dedup_key() -> Column:
    """Key of an exact duplicate, over the nine identifying fields in fixed order."""
    return hash_key(
        F.col("user_id"),
        epoch_millis("event_time_utc"),
        F.col("event_type"),
        F.col("product_id"),
        F.col("category_id"),
        F.col("category_code"),
        F.col("brand"),
        F.col("normalized_price"),
        F.col("raw_user_session"),
    )


def session_id(user_id: Column | str = "user_id", start: Column | str = "session_start_time_utc") -> Column:
    u = F.col(user_id) if isinstance(user_id, str) else user_id
    return hash_key(u, epoch_millis(start))
