"""Recall of the kd-tree search in full blocks, where the chi-square stop ends most searches early."""

import numpy as np
import pytest

from activitykit.llm import nearest


def _rows(kind, n, dim):
    r = np.random.default_rng(1)
    if kind == "gaussian":
        return r.standard_normal((n, dim))
    centres = r.standard_normal((200, dim))
    return centres[r.integers(0, 200, n)] + 0.5 * r.standard_normal((n, dim))


@pytest.mark.parametrize("kind", ["gaussian", "clustered"])
def test_recall_in_a_full_block(kind):
    n, dim, k = nearest.BLOCK_ROWS, 64, 20
    x = _rows(kind, n, dim)
    longest = float(np.sqrt(np.square(x).sum(axis=1).max()))
    lifted = np.c_[x, np.sqrt(np.maximum(longest**2 - np.square(x).sum(axis=1), 0))] / longest
    directions = np.random.default_rng([nearest.SEED, dim]).standard_normal((dim + 1, nearest.PROJECTIONS))
    tree = nearest.KdTree(lifted @ directions)
    vectors, ids = x[tree.order], tree.order
    limit, hits, met, asked = nearest.chi2_quantile(nearest.CONFIDENCE, nearest.PROJECTIONS), 0, 0, 40
    for own in range(asked):
        query = x[own]
        at = (query / np.sqrt(query @ query)) @ directions[:-1]
        rows, scores = nearest._search(tree, vectors, ids, longest, query, own, at, k, limit)
        exact = x @ query
        exact[own] = -np.inf
        hits += len(set(np.argsort(-exact)[:k].tolist()) & set(ids[rows].tolist()))
        assert scores == pytest.approx(exact[ids[rows]])
    assert len(tree.starts) > 500  # many leaves: the search is not exhaustive by its first step
    assert hits / (asked * k) >= 0.95
