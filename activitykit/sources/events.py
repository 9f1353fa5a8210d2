"""Adapter from the driver's ``events`` table to the raw click-stream schema.

Mapping (all rows, every run):
  event_time   = ts formatted as ``yyyy-MM-dd HH:mm:ss 'UTC'`` (whole seconds)
  event_type, user_id kept; price = value; user_session = event_id as text
  product_id   = props ``$.k`` as bigint; category_id = product_id % 10;
  category_code = 'cat.' || category_id; brand NULL

The table is clean, so ``dirty=True`` injects deterministic faults into the full
table to exercise validation and deduplication. Each rule rewrites one field of
the rows whose event_id is a multiple of a fixed prime, and the rows whose id is
a multiple of 37 appear twice (exact copies). No row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.schema import RAW_SCHEMA

# Fixed fault rules of the dirty view (event_id multiple → fault).
DIRT_NULL_USER_ID = 211
DIRT_NULL_EVENT_TYPE = 223
DIRT_NULL_PRODUCT_ID = 227
DIRT_BAD_TIME = 229
DIRT_NEGATIVE_PRICE = 233
DIRT_DUPLICATE = 37
# Fixed faults of the text view (event_id multiple → a number that does not parse).
DIRT_TEXT_PRODUCT = 239
DIRT_TEXT_PRICE = 241
BAD_TIME_TEXT = "bad-time"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def events_as_activity(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return activity_from_events(read_events(spark, sf_dir), dirty)


def events_as_text_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean rows with every field as text, some numbers of which do not parse."""
    rows = events_as_activity(spark, sf_dir).withColumn("price", F.col("price").try_cast("decimal(18,2)"))
    text = rows.select(*[F.col(f.name).cast("string") for f in RAW_SCHEMA.fields])
    event_id = F.col("user_session").cast("bigint")
    return text.withColumns({
        "product_id": F.when(event_id % DIRT_TEXT_PRODUCT == 0, F.concat(F.lit("k"), "product_id")).otherwise(F.col("product_id")),
        "price": F.when(event_id % DIRT_TEXT_PRICE == 0, F.concat(F.lit("about "), "price")).otherwise(F.col("price")),
    })


def activity_from_events(events: DataFrame, dirty: bool = False) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    e = F.col("event_id")

    def hit(prime: int):
        return (e % F.lit(prime)) == F.lit(0) if dirty else F.lit(False)

    text_time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'")
    raw = events.select(
        F.when(hit(DIRT_BAD_TIME), F.lit(BAD_TIME_TEXT)).otherwise(text_time).alias("event_time"),
        F.when(hit(DIRT_NULL_EVENT_TYPE), F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        F.when(hit(DIRT_NULL_PRODUCT_ID), F.lit(None)).otherwise(k).alias("product_id"),
        (k % F.lit(10)).alias("category_id"),
        F.concat(F.lit("cat."), (k % F.lit(10)).cast("string")).alias("category_code"),
        F.lit(None).cast("string").alias("brand"),
        F.when(hit(DIRT_NEGATIVE_PRICE), -F.col("value")).otherwise(F.col("value")).alias("price"),
        F.when(hit(DIRT_NULL_USER_ID), F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        e.cast("string").alias("user_session"),
        F.explode(F.when(hit(DIRT_DUPLICATE), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields])
