"""O1: raw click-stream CSV scan (header line, fixed schema by position), and its malformed lines.

A line is malformed when it does not fit the schema: a number that does not parse, or too few or
too many fields. The scan is PERMISSIVE, so such a line still gives a row; ``keep_malformed`` keeps
the line itself and where it lies, which validation carries into the dead-letter payload, and
:func:`malformed_lines` gives the exact byte place of every malformed line of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activitykit.schema import MALFORMED_LINE, RAW_SCHEMA, SOURCE_BLOCK_START, SOURCE_FILE

_WITH_LINE = T.StructType([*RAW_SCHEMA.fields, T.StructField(MALFORMED_LINE, T.StringType())])


def read_activity_csv(spark: SparkSession, path: str, keep_malformed: bool = False) -> DataFrame:
    """File or directory of CSV with a header. PERMISSIVE: an unparsable number
    becomes NULL, so such a row is rejected by validation rather than by the reader.

    With ``keep_malformed`` a row of a malformed line also carries the line, its file and the
    first byte of the file block it was read from (all NULL on well-formed lines).
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if not keep_malformed:
        return reader.schema(RAW_SCHEMA).csv(path)
    rows = reader.option("columnNameOfCorruptRecord", MALFORMED_LINE).schema(_WITH_LINE).csv(path)
    broken = F.col(MALFORMED_LINE).isNotNull()
    return rows.select(
        *_WITH_LINE.names,
        F.when(broken, F.col("_metadata.file_path")).alias(SOURCE_FILE),
        F.when(broken, F.col("_metadata.file_block_start")).alias(SOURCE_BLOCK_START),
    )


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, byte_offset, malformed_line) of every line that does not fit the schema.

    ``byte_offset`` is the line's first byte in its file (in the uncompressed text of a compressed
    one; a byte order mark is not counted). The text is cut into lines by the distributed reader,
    which hands out file blocks; a block's first line begins where the lines of the file's earlier
    blocks end. So the offset is the bytes of the earlier blocks (an aggregate, a row per block)
    plus those of the earlier lines of the block, a window that holds one block and is run for
    the blocks with a malformed line only.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(SOURCE_BLOCK_START),
        F.monotonically_increasing_id().alias("_line"),  # rises along a block, which one task reads
        (F.octet_length("value") + F.lit(1)).cast("long").alias("_bytes"),
        F.rtrim(F.col("value"), F.lit("\r")).alias("_text"),
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED_LINE}
    blank = F.trim("_text") == F.lit("")
    parsed = F.when(~blank, F.from_csv("_text", F.lit(_WITH_LINE.simpleString()), options)[MALFORMED_LINE])
    block = [SOURCE_FILE, SOURCE_BLOCK_START]
    marked = lines.withColumn(MALFORMED_LINE, parsed)
    blocks = marked.groupBy(*block).agg(
        F.sum("_bytes").alias("_block_bytes"),
        F.count(MALFORMED_LINE).alias("_malformed"),
    )
    earlier_blocks = Window.partitionBy(SOURCE_FILE).orderBy(SOURCE_BLOCK_START).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.withColumn("_first_byte", F.coalesce(F.sum("_block_bytes").over(earlier_blocks), F.lit(0)))
        .where(F.col("_malformed") > 0)
        .select(*block, "_first_byte")
    )
    earlier_lines = Window.partitionBy(*block).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    return (
        marked.select(*block, "_line", "_bytes", MALFORMED_LINE)
        .join(starts, block)
        .withColumn("byte_offset", F.col("_first_byte") + F.coalesce(F.sum("_bytes").over(earlier_lines), F.lit(0)))
        .where(F.col(MALFORMED_LINE).isNotNull() & (F.col("byte_offset") > 0))  # byte 0 is the header
        .select(SOURCE_FILE, "byte_offset", MALFORMED_LINE)
    )


def write_activity_csv(df: DataFrame, path: str) -> None:
    """Writes raw rows (S0) as header CSV, the format :func:`read_activity_csv` reads."""
    df.write.mode("overwrite").option("header", True).csv(path)
