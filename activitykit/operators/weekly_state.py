"""O39, O40 as mergeable state: exact distinct counts a week from bitmaps a day.

Ids (users, sessions) get dense numbers from a dictionary that only grows. A day's state is, per week
and bucket of 32,768 numbers, a bitmap of the ids active on that day. A week's count is the OR of its
days' bitmaps, bits counted. So a run reads its own days of the table only: it extends the
dictionary by the ids it has not seen, rewrites its days' bitmaps, and merges the weeks it touches
from bitmaps, which are far smaller than the events. Re-running a day replaces its bitmaps, so the
counts stay exact where an approximate sketch, or a running sum, could not be corrected.

Layout under ``base``::

    ids/part=<k>/                     (id, code), the ids that the k-th extension added
    days/event_date_kst=<day>/        (week_start_kst, bucket, bits)

*Scale.* New ids are one partial distinct and an anti join; they are numbered by their place within
their partition plus the rows of the partitions before, so no task sees them all. Bitmaps are built
with a map-side partial aggregate: a user with a third of all events is one bit a map task.

Edge cases: null ids are not counted, as in a distinct count; a day without rows has no bitmaps and
its earlier ones go; an id seen by an extension whose run broke off keeps its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.operators.weekly import week_filter
from activitykit.runtime import scratch_path
from activitykit.sources import fs

USERS = ("user_id", "week_start_kst", "wau_users")
SESSIONS = ("session_id", "session_start_week_kst", "weekly_active_sessions")


class WeeklyState:
    """The dictionary and the day bitmaps of one metric: an id column, its week column and the count's name."""

    def __init__(self, spark: SparkSession, base: str, metric: tuple[str, str, str] = USERS):
        self.spark = spark
        self.id, self.week, self.count_name = metric
        self.base = f"{base.rstrip('/')}/{self.count_name}"

    def _parts(self) -> list[int]:
        return sorted(int(n.split("=", 1)[1]) for n in fs.list_dirs(self.spark, f"{self.base}/ids") if n.startswith("part="))

    def codes(self) -> DataFrame | None:
        """(id, code) of every id seen."""
        whole = [k for k in self._parts() if fs.exists(self.spark, f"{self.base}/ids/part={k}/_SUCCESS")]
        if not whole:
            return None
        return self.spark.read.parquet(*[f"{self.base}/ids/part={k}" for k in whole])

    def _extend(self, rows: DataFrame) -> None:
        """Numbers the ids of ``rows`` that the dictionary lacks."""
        ids = rows.select(F.col(self.id).alias("id")).distinct()
        known = self.codes()
        first = 0
        if known is not None:
            ids = ids.join(known, "id", "left_anti")
            first = known.agg(F.max("code")).first()[0] + 1
        path = scratch_path(self.spark, "new-ids")
        ids.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)  # written: places stay as they are
        new = self.spark.read.parquet(path)
        part = F.shiftright("_at", 33)
        counts = dict(new.groupBy(part.alias("p")).count().collect())  # a row a partition
        if not counts:
            return
        offsets, before = [], first
        for p in sorted(counts):
            offsets.append((p, before))
            before += counts[p]
        starts = self.spark.createDataFrame(offsets, "_p long, _start long")
        place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
        coded = new.withColumn("_p", part).join(F.broadcast(starts), "_p").select("id", (F.col("_start") + place).alias("code"))
        coded.write.mode("overwrite").parquet(f"{self.base}/ids/part={max(self._parts(), default=0) + 1}")

    def update(self, rows: DataFrame, days: list[str]) -> None:
        """Replaces the bitmaps of ``days`` by those of ``rows``, the table's rows of just these days."""
        path = scratch_path(self.spark, "day-ids")
        kept = rows.select("event_date_kst", F.col(self.week).alias("week_start_kst"), F.col(self.id)).where(F.col(self.id).isNotNull())
        kept.distinct().write.parquet(path)  # the events are read once; a busy id is a row a day from here on
        rows = self.spark.read.schema(kept.schema).parquet(path)
        self._extend(rows)
        known = self.codes()
        if known is not None:
            coded = rows.join(known.withColumnRenamed("id", self.id), self.id)
            bits = coded.groupBy("event_date_kst", "week_start_kst", F.bitmap_bucket_number("code").alias("bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits")
            )
            out = bits.hint("rebalance", "event_date_kst").write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
            out.partitionBy("event_date_kst").parquet(f"{self.base}/days")
        active = {str(r[0]) for r in rows.select("event_date_kst").distinct().collect()}  # a row a day
        for day in set(days) - active:
            fs.delete(self.spark, f"{self.base}/days/event_date_kst={day}")

    def days(self) -> list[str]:
        """The days that have bitmaps."""
        return [n.split("=", 1)[1] for n in fs.list_dirs(self.spark, f"{self.base}/days") if n.startswith("event_date_kst=")]

    def counts(self, week_from: str | None = None, week_to: str | None = None) -> DataFrame:
        """(week_start_kst, count) of the weeks, from bitmaps alone."""
        schema = "week_start_kst date, bucket long, bits binary, event_date_kst date"
        if not fs.exists(self.spark, f"{self.base}/days"):
            return self.spark.createDataFrame([], f"week_start_kst date, {self.count_name} long")
        bits = self.spark.read.schema(schema).parquet(f"{self.base}/days")
        chosen = week_filter("week_start_kst", week_from, week_to)
        if chosen is not None:
            bits = bits.where(chosen)
            if week_from:  # an id's day never lies before its week
                bits = bits.where(F.col("event_date_kst") >= F.lit(week_from).cast("date"))
        merged = bits.groupBy("week_start_kst", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
        return merged.groupBy("week_start_kst").agg(F.sum("n").cast("long").alias(self.count_name)).orderBy("week_start_kst")
