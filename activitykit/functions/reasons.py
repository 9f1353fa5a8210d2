"""Validity rules and reject-reason text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activitykit.schema import (
    REASON_INVALID_EVENT_TIME,
    REASON_NEGATIVE_PRICE,
    REASON_NULL_EVENT_TYPE,
    REASON_NULL_PRODUCT_ID,
    REASON_NULL_USER_ID,
    REASON_SEPARATOR,
)


def rule_columns() -> list[tuple[str, Column]]:
    """(code, failed?) per rule, in the order codes are joined. Each is never NULL."""
    return [
        (REASON_INVALID_EVENT_TIME, F.col("event_time_utc").isNull()),
        (REASON_NULL_USER_ID, F.col("user_id").isNull()),
        (REASON_NULL_EVENT_TYPE, F.col("event_type").isNull()),
        (REASON_NULL_PRODUCT_ID, F.col("product_id").isNull()),
        # A NULL price is valid; only a known negative price is rejected.
        (REASON_NEGATIVE_PRICE, F.coalesce(F.col("price") < F.lit(0.0), F.lit(False))),
    ]


def is_invalid() -> Column:
    rules = [c for _, c in rule_columns()]
    out = rules[0]
    for c in rules[1:]:
        out = out | c
    return out


def reject_reason() -> Column:
    """Codes of every failed rule joined by ``|`` (``concat_ws`` skips the passed ones)."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(c, F.lit(code)) for code, c in rule_columns()])
