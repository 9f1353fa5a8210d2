"""Hard negatives by a secondary-sort shuffle.

For each anchor, its ``positives`` best-scored other rows of the same label open a window each: a
negative (a row of another label) belongs to it if ``low * positive <= 100 * negative <= high *
positive``, both scores being inner products of the quantised vectors ``floor(scale * x)``. The
first ``negatives`` rows of each window are mined, best first, ties to the smaller vec_id.

*Pair scores.* The anchors are a stated query set and meet all rows in blocks: rows are dealt into
blocks, anchors into parts, and one task scores one block against one part, some anchors at a time.
*Secondary sort.* Scored pairs are shuffled by anchor and sorted within partitions by the packed key
(anchor, score descending, positives before negatives, vec_id), as ``repartitionAndSortWithinPartitions``
does, by ``repartition`` and ``sortWithinPartitions``: the sort is the JVM's and spills to disk.
*Iterator.* A task streams its sorted partition: an anchor's positives come first by score and open
its windows, the negatives after them fill the windows. It keeps one anchor's open windows only.

Before the shuffle a block gives up the pairs that cannot be mined: of the same label all but its
``positives`` best, since no other can be among the best of all blocks; then, the windows being
known from those, of other labels all but the first ``negatives`` of each window. Nothing that could
be mined is dropped, and no anchor's pairs are ever held together.

Edge cases: rows with a null vec_id or label, a null vector, or a null or non-finite component take
no part (an empty vector scores 0 with empty ones); vectors only meet vectors of their own length;
rows that agree in vec_id, label and vector count once; of rows that share a vec_id the least by
(label, vector) is the anchor and all are candidates of other anchors, never of their own; a
positive of score 0 takes negatives of score 0, a negative one none; an anchor without a positive or
without negatives gives no row; scores past 64 bits are clipped to that range; an empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SCALE = 256
BLOCK_ROWS = 4096
PART_ANCHORS = 2048
AT_ONCE = 1 << 21  # scores held at a time in one task
PAIRS = "anchor_id long, score long, kind int, vec_id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
EXACT = float(1 << 53)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding, dim) of the rows that take part, each once."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = wide.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return kept.dropDuplicates().withColumn("dim", F.size("embedding"))


def _matrix(column: pa.ChunkedArray, dim: int, scale: float) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        whole = np.floor(scale * flat.astype(np.float64))
    return np.clip(whole, -np.finfo(np.float64).max, np.finfo(np.float64).max).reshape(len(column), dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of integer-valued rows, exact; clipped to 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)  # every partial sum is a whole number below 2^53
    whole = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and greatest negative score that a positive of this score admits."""
    return -((-low * score) // 100), (high * score) // 100


def _scorer(scale: float, choose):
    """Scores a part's anchors against a block; ``choose`` names the pairs that go on."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        for dim in pc.unique(anchors.column("dim")).to_pylist() if rows.num_rows else []:
            mine = rows.filter(pc.equal(rows.column("dim"), dim)).sort_by("vec_id")
            asked = anchors.filter(pc.equal(anchors.column("dim"), dim))
            if not mine.num_rows:
                continue
            ids, labels = mine.column("vec_id").to_numpy(), mine.column("label").to_numpy()
            vectors, queries = _matrix(mine.column("embedding"), dim, scale), _matrix(asked.column("embedding"), dim, scale)
            own, own_label = asked.column("vec_id").to_pylist(), asked.column("label").to_pylist()
            bounds = asked.column("scores").to_pylist() if "scores" in asked.column_names else [None] * len(own)
            step = max(1, AT_ONCE // len(ids))
            for first in range(0, len(own), step):
                for at, line in enumerate(_products(queries[first : first + step], vectors), first):
                    taken, kind = choose(line, labels == own_label[at], ids != own[at], bounds[at])
                    out[0].append(np.full(len(taken), own[at]))
                    out[1].append(line[taken])
                    out[2].append(np.full(len(taken), kind, np.int32))
                    out[3].append(ids[taken])
        columns = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in PAIRS.split(", ")])

    return run


def _best(line: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``rows`` by score descending, ties by vec_id (their order)."""
    return rows[np.argsort(-line[rows], kind="stable")]


def _choose_positives(positives: int):
    def choose(line, same, other, _):
        return _best(line, np.flatnonzero(same & other))[:positives], 0

    return choose


def _choose_negatives(negatives: int, low: int, high: int):
    def choose(line, same, other, scores):
        windows = [window_of(s, low, high) for s in scores]
        rows = np.flatnonzero(~same & other & (line >= min(a for a, _ in windows)) & (line <= max(b for _, b in windows)))
        rows = _best(line, rows)
        found = line[rows]
        return rows[np.unique(np.concatenate([np.flatnonzero((found >= a) & (found <= b))[:negatives] for a, b in windows]))], 1

    return choose


def _stream(positives: int, negatives: int, low: int, high: int):
    """Reads pairs in key order; open windows of one anchor are all it keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened = None, []  # [positive_id, score, least, greatest, given] of each window
        for batch in batches:
            anchors, scores, kinds, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]]) if len(anchors) else np.zeros(0, int)
            for a, b in zip(starts, [*starts[1:], len(anchors)]):
                if anchors[a] != anchor:
                    anchor, opened = int(anchors[a]), []
                place = np.arange(a, b)
                for i in place[kinds[a:b] == 0][: positives - len(opened)].tolist():
                    opened.append([int(ids[i]), int(scores[i]), *window_of(int(scores[i]), low, high), 0])
                place = place[kinds[a:b] == 1]
                for window in opened:
                    positive, score, least, greatest, given = window
                    hit = place[(scores[place] >= least) & (scores[place] <= greatest)][: negatives - given]
                    window[4] += len(hit)
                    n = len(hit)
                    for column, values in zip(out, (np.full(n, anchor), np.full(n, positive), given + 1 + np.arange(n), ids[hit], np.full(n, score), scores[hit])):
                        column.append(values)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, types)], [c.split()[0] for c in MINED.split(", ")])

    return run


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
    block_rows: int = BLOCK_ROWS,
    part_anchors: int = PART_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all mined negatives."""
    rows = cut_lineage(usable(vectors))
    least = F.min(F.struct("label", "embedding", "dim")).alias("row")
    anchors = cut_lineage(rows.filter(is_anchor).groupBy("vec_id").agg(least).select("vec_id", "row.*"))
    blocks, parts = max(1, -(-rows.count() // block_rows)), max(1, -(-anchors.count() // part_anchors))

    def spread(df: DataFrame, seed: int, n: int, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id", "label", "embedding", F.lit(seed)), F.lit(n)).cast("int"))

    def copied(df: DataFrame, n: int, name: str) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    dealt = copied(spread(rows, 1, blocks, "block"), parts, "part").groupBy("block", "part")

    def scored(asked: DataFrame, choose) -> DataFrame:
        met = copied(spread(asked, 2, parts, "part"), blocks, "block").groupBy("block", "part")
        return dealt.cogroup(met).applyInArrow(_scorer(scale, choose), PAIRS)

    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = scored(anchors, _choose_positives(positives))
    near = cut_lineage(near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives).drop("n"))
    opened = near.groupBy("anchor_id").agg(F.collect_list("score").alias("scores"))  # at most ``positives`` each
    asked = cut_lineage(anchors.join(opened.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))
    far = scored(asked, _choose_negatives(negatives, low, high))
    key = [F.col("anchor_id"), F.desc("score"), F.col("kind"), F.col("vec_id")]
    return near.unionAll(far).repartition("anchor_id").sortWithinPartitions(*key).mapInArrow(_stream(positives, negatives, low, high), MINED)


MINE_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n USING (anchor_id)
WHERE NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 10
"""
