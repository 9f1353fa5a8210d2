"""Quality rules: base rules per document plus a hashed n-gram log-likelihood ratio.

Two multinomials over ``buckets`` hash buckets of word unigrams and bigrams (ASCII lower case):
one of the trusted target, one of the whole raw corpus, each smoothed by ``alpha``. A document's
score is the mean over its n-grams of log p_target - log p_raw. It is kept if the base rules pass
and the score is at least ``threshold``; every document gets a verdict.

The target is a bounded sample of labelled rows: the ``target_rows`` trusted ids (quality 1, not
toxic) with the smallest hash. The raw counts cover all documents. Map tasks add up their own
buckets, so at most ``buckets`` rows a task are shuffled; what is broadcast is one weight a bucket.

Edge cases: a null or empty text has no words and fails the base rules (``n_words < 10``); with no
trusted rows or an empty corpus every score is 0 and the base rules decide; repeated rows are
judged alike, one result row each; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.llm.common import MIX, coded, mix64, per_text, plain, slices, texts_of, words_of

BUCKETS = 1 << 14
ALPHA = 1.0
TARGET_ROWS = 20_000
THRESHOLD = -0.1
SYMBOLS = "#*$%&|<>"
RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, llr double, kept boolean"
)


def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, plain(pc.ascii_lower(words))), np.uint64, len(words))


def _grams(codes: np.ndarray, table: pa.Array, starts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the unigram and of the bigram at each word (-1: no bigram begins there)."""
    h = _word_hashes(table)[codes] if len(codes) else np.zeros(0, np.uint64)
    one = (mix64(h) % np.uint64(buckets)).astype(np.int64)
    two = np.full(len(h), -1, np.int64)
    if len(h) > 1:
        two[:-1] = (mix64(h[:-1] * MIX + h[1:]) % np.uint64(buckets)).astype(np.int64)
        lasts = starts[1:][starts[1:] > starts[:-1]] - 1
        two[lasts] = -1
    return one, two


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often the corpus' unigrams and bigrams fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches):
            words, starts = words_of(texts_of(part))
            one, two = _grams(*coded(words), starts, buckets)
            total += np.bincount(one, minlength=buckets) + np.bincount(two[two >= 0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_rows(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """The documents of the target sample; the broadcast side has at most ``target_rows`` ids."""
    ids = (
        labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(target_rows)
    )
    return docs.join(F.broadcast(ids), "doc_id", "left_semi")


def fit_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """log p_target - log p_raw of each bucket (``buckets`` numbers, whatever the corpus)."""
    raw = bucket_counts(docs, buckets).withColumn("t", F.lit(0))
    target = bucket_counts(trusted_rows(docs, labels, target_rows), buckets).withColumn("t", F.lit(1))
    n = np.zeros((2, buckets))
    for r in raw.unionByName(target).collect():
        n[r.t, r.bucket] = r.n
    if not n[1].sum():
        return np.zeros(buckets)
    p = np.log(n + alpha) - np.log(n.sum(1, keepdims=True) + alpha * buckets)
    return p[1] - p[0]


def _repeat_words(codes: np.ndarray, starts: np.ndarray, width: int = 5) -> np.ndarray:
    """Words per text that lie in a window of ``width`` words found twice or more in that text."""
    n, texts = len(codes), len(starts) - 1
    if n < width:
        return np.zeros(texts, np.int64)
    owner = np.repeat(np.arange(texts), np.diff(starts))
    key = codes[: n - width + 1].astype(np.uint64)
    for j in range(1, width):
        key = mix64(key * MIX + codes[j : n - width + 1 + j].astype(np.uint64))
    inside = owner[: n - width + 1] == owner[width - 1 :]
    where = np.flatnonzero(inside)
    key = mix64(key[where] * MIX + owner[where].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(where), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, where[twice], 1)
    np.add.at(mark, where[twice] + width, -1)
    return per_text(np.cumsum(mark[:-1]) > 0, starts)


def _dup_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    worded = pc.match_substring_regex(lines, "[^\\x20\\x09-\\x0D]").to_numpy(zero_copy_only=False)
    codes, table = coded(lines.filter(pa.array(worded)))
    owner = owner[worded]
    distinct = np.unique(owner.astype(np.int64) * max(len(table), 1) + codes) // max(len(table), 1)
    return np.bincount(owner, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def _symbols(texts: pa.Array) -> np.ndarray:
    raw = [t.encode() for t in plain(texts)]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=starts[1:])
    table = np.zeros(256, np.uint8)
    table[[ord(c) for c in SYMBOLS]] = 1
    return per_text(table[np.frombuffer(b"".join(raw), np.uint8)], starts)


def quality(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, keep_columns: bool = False) -> DataFrame:
    """The verdict of each row (``RESULT``); with ``keep_columns`` the rows of ``docs`` that are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    buckets = len(weights)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = texts_of(part)
            words, starts = words_of(texts)
            codes, table = coded(words)
            n_words = np.diff(starts)
            one, two = _grams(codes, table, starts, buckets)
            w = shared.value
            gain = w[one] + np.where(two >= 0, w[np.maximum(two, 0)], 0.0)
            grams = per_text(np.ones(len(one)) + (two >= 0), starts, np.float64)
            llr = per_text(gain, starts, np.float64) / np.maximum(grams, 1)
            chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
            repeat = _repeat_words(codes, starts)
            failed = (n_words < 10) | (100 * repeat > 20 * n_words)
            kept = ~failed & (llr >= threshold)
            if keep_columns:
                yield part.filter(pa.array(kept))
                continue
            columns = [part.column("doc_id"), n_words, per_text(chars, starts), _symbols(texts), _dup_lines(texts), repeat, failed, llr, kept]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], [x.split()[0] for x in RESULT.split(", ")])

    if keep_columns:
        return docs.mapInArrow(judge, docs.schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judge, RESULT)
