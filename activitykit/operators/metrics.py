"""Stage counts, reject-reason histogram, DLQ ratio, sessions, partitions.

Each is a Spark aggregate; when a pipeline writes its outputs, the same counts
are taken for free with ``DataFrame.observe`` on the write (see plans.batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.functions.reasons import is_invalid


def reason_histogram(invalid: DataFrame) -> DataFrame:
    """Rows per (joined) reject reason."""
    return invalid.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("count"))


def reason_display(invalid: DataFrame, n: int = 20) -> DataFrame:
    """The top ``n`` reasons, most frequent first, ties by reason."""
    return reason_histogram(invalid).orderBy(F.col("count").desc(), F.col("reject_reason")).limit(n)


def dlq_ratio(normalized: DataFrame) -> DataFrame:
    """Invalid ÷ input over the whole (not date-filtered) input; 0 when empty."""
    return (
        normalized.agg(
            F.count(F.lit(1)).alias("input_row_count"),
            F.count_if(is_invalid()).alias("invalid_row_count"),
        )
        .withColumn(
            "dlq_ratio",
            F.when(F.col("input_row_count") == 0, F.lit(0.0)).otherwise(
                F.col("invalid_row_count").cast("double") / F.col("input_row_count").cast("double")
            ),
        )
    )


def ratio(invalid_rows: int, input_rows: int) -> float:
    return 0.0 if input_rows == 0 else invalid_rows / input_rows


def _stacked(row: DataFrame) -> DataFrame:
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).alias("row_count")) for c in row.columns])))


def stage_counts(normalized: DataFrame, sessionized: DataFrame) -> DataFrame:
    """One (stage, row_count) row per stage: one pass over the input, one over the sessions."""
    read = normalized.agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(~is_invalid()).alias("valid"),
        F.count_if(is_invalid()).alias("invalid"),
    )
    kept = sessionized.agg(
        F.count("dedup_key").alias("deduplicated"),
        F.count("session_start_time_utc").alias("sessionized"),
    )
    return _stacked(read).unionByName(_stacked(kept))


def unique_sessions(sessionized: DataFrame) -> DataFrame:
    """COUNT(DISTINCT session_id)."""
    return sessionized.agg(F.count_distinct("session_id").alias("unique_session_count"))


def output_partitions(sessionized: DataFrame) -> DataFrame:
    """The sorted distinct KST dates (one day partition each)."""
    return sessionized.select("event_date_kst").distinct().orderBy("event_date_kst")


def output_partition_summary(sessionized: DataFrame) -> DataFrame:
    """Number of day partitions and the first and last day."""
    return sessionized.agg(
        F.count_distinct("event_date_kst").alias("output_partition_count"),
        F.min("event_date_kst").alias("output_partition_start"),
        F.max("event_date_kst").alias("output_partition_end"),
    )
