"""Exact-duplicate removal and duplicate-group statistics.

One aggregation over ``dedup_key`` yields both the surviving row and the group
size. It is a hash-partitioned aggregate with a map-side partial step, so a key
that holds a large share of all rows is collapsed inside each map task before
the shuffle and never lands whole on one reducer.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.functions.keys import dedup_key

# Inside one key group only these may differ (the key fixes everything else);
# the survivor is the row that is lowest on them, so it is deterministic. The KST
# time follows from event_time_utc.
SURVIVOR_ORDER = ["price", "event_time_utc", "event_time", "event_time_kst"]


class DeduplicationResult(NamedTuple):
    deduplicated: DataFrame
    duplicate_groups: DataFrame


def with_dedup_key(df: DataFrame) -> DataFrame:
    return df.withColumn("dedup_key", dedup_key())


def _grouped(keyed: DataFrame) -> DataFrame:
    free = [c for c in SURVIVOR_ORDER if c in keyed.columns]
    fixed = [c for c in keyed.columns if c not in free and c != "dedup_key"]
    # one aggregate a column, so that columns nobody reads are pruned before the shuffle
    return keyed.groupBy("dedup_key").agg(
        F.min(F.struct(*free)).alias("_free"),
        *[F.first(c).alias(c) for c in fixed],
        F.count(F.lit(1)).alias("duplicate_group_size"),
    )


def deduplicate(df: DataFrame, keep_group_size: bool = False) -> DeduplicationResult:
    """Returns (one row per dedup_key with S1 columns + dedup_key, groups of size > 1).

    With ``keep_group_size`` the deduplicated rows also carry
    ``duplicate_group_size``, so group metrics can be read off the same pass.
    """
    keyed = with_dedup_key(df)
    grouped = _grouped(keyed)
    out_cols = [F.col(f"_free.{c}" if c in SURVIVOR_ORDER else c).alias(c) for c in keyed.columns if c != "dedup_key"] + [F.col("dedup_key")]
    if keep_group_size:
        out_cols.append(F.col("duplicate_group_size"))
    deduplicated = grouped.select(*out_cols)
    return DeduplicationResult(deduplicated, duplicate_groups_of(grouped))


def duplicate_groups_of(grouped: DataFrame) -> DataFrame:
    """Groups with more than one row: (dedup_key, duplicate_group_size, dropped_duplicate_row_count)."""
    return grouped.filter(F.col("duplicate_group_size") > 1).select(
        "dedup_key",
        "duplicate_group_size",
        (F.col("duplicate_group_size") - F.lit(1)).alias("dropped_duplicate_row_count"),
    )


def duplicate_metrics(duplicate_groups: DataFrame) -> DataFrame:
    """One row: group count, rows in groups, rows dropped (0, not NULL, when none)."""
    return duplicate_groups.agg(
        F.count(F.lit(1)).alias("duplicate_group_count"),
        F.coalesce(F.sum("duplicate_group_size"), F.lit(0)).cast("long").alias("duplicate_rows_count"),
        F.coalesce(F.sum("dropped_duplicate_row_count"), F.lit(0)).cast("long").alias("dropped_duplicate_rows_count"),
    )
