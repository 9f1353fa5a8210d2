"""valid/invalid split, reject reasons, dead-letter fields, KST date range."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.functions.reasons import is_invalid, reject_reason
from activitykit.schema import MALFORMED_FIELDS, RAW_PAYLOAD_FIELDS


class ValidationResult(NamedTuple):
    valid: DataFrame
    invalid: DataFrame


def validate(df: DataFrame, target_date: str) -> ValidationResult:
    """Two complementary filters over one parent; the predicate is never NULL.

    Invalid rows get ``reject_reason`` (every failed rule), ``target_date`` (their
    KST date, or ``target_date`` when the time did not parse) and ``raw_payload``
    (the raw fields as JSON; NULL fields are left out). Of a malformed line that the
    reader kept, the payload also holds the line and its place; the columns themselves
    end here, so both results have the same columns with and without them.
    """
    bad = is_invalid()
    kept = [c for c in MALFORMED_FIELDS if c in df.columns]
    invalid = df.filter(bad).withColumns(
        {
            "reject_reason": reject_reason(),
            "target_date": F.coalesce(F.col("event_date_kst").cast("string"), F.lit(target_date)),
            "raw_payload": F.to_json(F.struct(*[F.col(c) for c in RAW_PAYLOAD_FIELDS + kept])),
        }
    ).drop(*kept)
    valid = df.filter(~bad).drop(*kept)
    return ValidationResult(valid, invalid)


def filter_kst_range(df: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Rows whose KST date lies in [start_date, end_date], both inclusive."""
    lo = F.lit(dt.date.fromisoformat(start_date).isoformat()).cast("date")
    hi = F.lit(dt.date.fromisoformat(end_date).isoformat()).cast("date")
    return df.filter(F.col("event_date_kst").between(lo, hi))
