"""Approximate nearest neighbours by inner product: stable projections, a kd-tree, an early stop.

Inner product becomes distance: a row ``x`` of at most length ``M`` gets one more coordinate so
that all rows lie on one sphere, ``(x, sqrt(M^2 - |x|^2)) / M``; a query is scaled to length one.
Nearer on the sphere then means a larger inner product. ``projections`` Gaussian (2-stable)
directions map the sphere down; for a row at true distance d the squared projected distance is
d^2 times a chi-square variable with that many degrees of freedom.

Rows are dealt into blocks; each block holds a kd-tree over its projected rows. A query takes the
leaves of the tree in order of their least possible projected distance and so meets rows by
growing projected distance; each row met is verified with its exact inner product. It stops when
the next projected distance r satisfies ``chi2_cdf((r / d_k)^2) >= confidence``, d_k being the true
distance of the k-th best row so far: a row not yet met beats it with probability at most
``1 - confidence``. Every row is indexed; no leaf or candidate count is capped. The blocks' best
rows are merged by score.

Queries meet all blocks (a stated query set against all rows), ``query_rows`` at a time.

Edge cases: null, empty or zero vectors and those with null or non-finite components take no part;
vectors only meet vectors of their own dimension; ties go to the smaller vec_id; a query's own
rows (same vec_id) are no candidates; repeated query rows are answered once; fewer candidates
than ``k`` give them all; an empty table gives none; rows without a vec_id take no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage

PROJECTIONS = 12
CONFIDENCE = 0.99
BLOCK_ROWS = 1 << 16
LEAST_BLOCKS = 12
QUERY_ROWS = 4096
LEAF_ROWS = 64
SEED = 7
FOUND = "query_id long, vec_id long, score double"


def chi2_quantile(p: float, degrees: int) -> float:
    """The value a chi-square variable stays under with probability ``p`` (bisection on its series)."""

    def cdf(x: float) -> float:
        term = total = 1.0 / (degrees / 2)
        n = degrees / 2
        while term > total * 1e-15:
            n += 1
            term *= (x / 2) / n
            total += term
        from math import exp, lgamma, log

        return total * exp(degrees / 2 * log(x / 2) - x / 2 - lgamma(degrees / 2))

    low, high = 1e-9, 1000.0 + 10 * degrees
    while high - low > 1e-9 * high:
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


class KdTree:
    """Leaves of about ``leaf_rows`` points, cut at medians of the widest axis; boxes bound each leaf."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        leaves, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf_rows:
                leaves.append(rows)
                continue
            axis = int(np.ptp(points[rows], axis=0).argmax())
            middle = len(rows) // 2
            rows = rows[np.argpartition(points[rows, axis], middle)]
            todo += [rows[:middle], rows[middle:]]
        self.order = np.concatenate(leaves)
        self.starts = np.r_[0, np.cumsum([len(r) for r in leaves])]
        self.points = points[self.order]
        self.low = np.minimum.reduceat(self.points, self.starts[:-1], axis=0)
        self.high = np.maximum.reduceat(self.points, self.starts[:-1], axis=0)

    def leaf_bounds(self, at: np.ndarray) -> np.ndarray:
        """Least squared distance from ``at`` to any point of each leaf."""
        return np.square(np.maximum(self.low - at, 0) + np.maximum(at - self.high, 0)).sum(axis=1)


def _search(tree: KdTree, vectors: np.ndarray, ids: np.ndarray, longest: float, query: np.ndarray, own: int, at: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the k best rows met before the stop. ``vectors``, ``ids`` and the result are in tree order; ``limit``: the chi-square quantile."""
    bounds = tree.leaf_bounds(at)
    leaves = np.argsort(bounds, kind="stable")
    bounds = bounds[leaves]
    norm = float(np.sqrt(query @ query))
    rows, scores = np.zeros(0, np.int64), np.zeros(0)
    waiting, gaps = np.zeros(0, np.int64), np.zeros(0)
    step, done = 16, 0
    while done < len(leaves) or len(waiting):
        taken = leaves[done : done + step]
        done += len(taken)
        step *= 2
        if len(taken):
            sizes = tree.starts[taken + 1] - tree.starts[taken]
            new = np.repeat(tree.starts[taken] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            waiting = np.r_[waiting, new]
            gaps = np.r_[gaps, np.square(tree.points[new] - at).sum(axis=1)]
        reach = bounds[done] if done < len(leaves) else np.inf
        met = gaps <= reach  # no unseen leaf holds a nearer point
        if len(scores) >= k:  # of those met, the ones the stop would not have passed
            met &= gaps < limit * 2 * max(0.0, 1 - scores.min() / (norm * longest))
        now = waiting[met]
        now = now[ids[now] != own]
        waiting, gaps = waiting[gaps > reach], gaps[gaps > reach]
        if len(now):
            rows = np.r_[rows, now]
            scores = np.r_[scores, vectors[now] @ query]
            if len(scores) > 2 * k:  # ties with the k-th stay until the ids decide
                able = scores >= np.partition(scores, -k)[-k]
                rows, scores = rows[able], scores[able]
            best = np.lexsort((ids[rows], -scores))[:k]
            rows, scores = rows[best], scores[best]
        if len(scores) >= k and reach >= limit * 2 * max(0.0, 1 - scores.min() / (norm * longest)):
            break
    return rows, scores


def _block_search(longest: float, k: int, projections: int, confidence: float, seed: int):
    limit = chi2_quantile(confidence, projections)

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        for size in queries["dim"].unique() if len(rows) else []:
            mine = rows[rows["dim"] == size]
            if mine.empty:
                continue
            vectors, ids = np.array(mine["embedding"].tolist(), np.float64), mine["vec_id"].to_numpy(np.int64)
            lifted = np.c_[vectors, np.sqrt(np.maximum(longest**2 - np.square(vectors).sum(axis=1), 0))] / longest
            directions = np.random.default_rng([seed, int(size)]).standard_normal((int(size) + 1, projections))
            tree = KdTree(lifted @ directions)
            vectors, ids = vectors[tree.order], ids[tree.order]
            asked = queries[queries["dim"] == size]
            for own, query in zip(asked["vec_id"].tolist(), asked["embedding"]):
                query = np.asarray(query, np.float64)
                at = (query / np.sqrt(query @ query)) @ directions[:-1]
                best, scores = _search(tree, vectors, ids, longest, query, own, at, k, limit)
                found.append(pd.DataFrame({"query_id": own, "vec_id": ids[best], "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, dim, norm) of the vectors that take part."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return wide.filter(F.col("vec_id").isNotNull() & finite).withColumn("dim", F.size("embedding")).withColumn("norm", norm).filter("norm > 0")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    projections: int = PROJECTIONS,
    confidence: float = CONFIDENCE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows found, nearest first."""
    rows = cut_lineage(usable(vectors))
    n, longest = rows.agg(F.count(F.lit(1)), F.max("norm")).first()
    asked = rows.filter(is_query).select("vec_id", "embedding", "dim").dropDuplicates(["vec_id"])
    blocks = max(LEAST_BLOCKS, -(-n // block_rows))
    groups = max(1, -(-asked.count() // query_rows))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    dealt = rows.select("vec_id", "embedding", "dim", F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks)).cast("int").alias("block"))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = dealt.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(_block_search(longest or 1.0, k, projections, confidence, seed), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
