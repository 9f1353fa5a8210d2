"""Shared helpers of the text operators: reading a table's columns, words, bounded slices.

Words are maximal runs of characters other than ``\\x20`` and ``\\x09``-``\\x0D``; a null text
counts as empty. Batches are cut into slices of at most ``SLICE_BYTES`` of text (one longer
text makes a slice of its own), so a task's memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.runtime import shared_dir

SLICE_BYTES = 2 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written once under the cluster's shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def crc_mod(col: str, divisor: int) -> Column:
    """CRC-32 of the value written as text, modulo ``divisor`` (null: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold at most ``limit`` bytes, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.take(pa.array(np.arange(first, last)))  # fresh buffers: split kernels misread arrays with an offset
            first = last
        pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds nothing


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words one after another, and where each text's words begin (one entry more than texts)."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    words = flat.filter(pa.array(real))
    starts = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.bincount(owner[real], minlength=len(counts)), out=starts[1:])
    return words, starts


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place in the table of distinct words, and that table."""
    if not len(words):
        return np.zeros(0, np.int64), words
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def plain(values: pa.Array) -> list:
    """The values as Python objects (by way of numpy, several times as fast as ``to_pylist``)."""
    return values.to_numpy(zero_copy_only=False).tolist()


def per_text(values: np.ndarray, starts: np.ndarray, dtype=np.int64) -> np.ndarray:
    """Sums of the values between the starts (0 for a text without values)."""
    total = np.zeros(len(values) + 1, dtype)
    np.cumsum(values, out=total[1:], dtype=dtype)
    return total[starts[1:]] - total[starts[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit affects all output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * MIX
    x = x ^ (x >> np.uint64(29))
    x = x * MIX
    return x ^ (x >> np.uint64(32))
