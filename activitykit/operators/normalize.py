"""Raw row → normalized row (UTC/KST times, KST date and week, decimal price)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.functions.time import parse_event_time, to_kst, week_start
from activitykit.schema import MALFORMED_FIELDS, PRICE_TYPE


def normalize(df: DataFrame, run_id: str) -> DataFrame:
    """Adds event_time_utc/kst, event_date_kst, week_start_kst, normalized_price,
    ingested_at, run_id and renames user_session → raw_user_session.

    Unparsable times and out-of-range prices become NULL (try_* under ANSI), so
    validation, not the parser, decides what is rejected. The place of a malformed line,
    where the reader kept it, comes along.
    """
    utc = parse_event_time("event_time")
    kst = to_kst(utc)
    date = F.to_date(kst)
    return df.select(
        "event_time",
        "event_type",
        "product_id",
        "category_id",
        "category_code",
        "brand",
        "price",
        "user_id",
        F.col("user_session").alias("raw_user_session"),
        utc.alias("event_time_utc"),
        kst.alias("event_time_kst"),
        date.alias("event_date_kst"),
        week_start(date).alias("week_start_kst"),
        F.col("price").try_cast(PRICE_TYPE).alias("normalized_price"),
        F.current_timestamp().alias("ingested_at"),
        F.lit(run_id).alias("run_id"),
        *[c for c in MALFORMED_FIELDS if c in df.columns],
    )
