"""Links among fingerprints that no popcount tells apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from activitykit.llm import simhash


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def _components(fp, pairs):
    parent = {int(x): int(x) for x in fp}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(int(a)), find(int(b))
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_thousands_of_fingerprints_of_one_popcount_vector(spark):
    """Each of the 32 two-bit segments has one bit: 2,500 distinct fingerprints, some with a neighbour one segment off."""
    r = np.random.default_rng(4)

    def spread(codes):
        out = np.zeros(len(codes), np.uint64)
        for k in range(32):
            out |= (np.uint64(1) << ((codes >> np.uint64(k)) & np.uint64(1))) << np.uint64(2 * k)
        return out

    codes = r.integers(0, 1 << 32, 2500).astype(np.uint64)
    beside = codes[:300] ^ (np.uint64(1) << r.integers(0, 32, 300).astype(np.uint64))
    fp = np.unique(spread(np.r_[codes, beside]))
    assert len(np.unique(simhash._popcounts(fp.view(np.int64)), axis=0)) == 1
    want = []
    for i, x in enumerate(fp):
        hit = np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ x) <= 3) + i + 1
        want += [(int(np.int64(x.view(np.int64))), int(fp[j : j + 1].view(np.int64)[0])) for j in hit]
    assert len(want) >= 300
    signed = fp.view(np.int64)
    df = spark.createDataFrame([(int(x),) for x in signed], "fp long").repartition(4)
    got = [(r.u, r.v) for r in simhash.fingerprint_links(df, 3, cell_rows=64).collect()]
    assert set(map(frozenset, got)) <= set(map(frozenset, want))
    assert _components(signed, got) == _components(signed, want)


def test_raw_cells_lose_no_near_pair(spark):
    """All fingerprints share three quarters of their bits, so the first run of bits splits nothing."""
    r = np.random.default_rng(6)
    fp = np.unique(r.integers(0, 1 << 14, 1500).astype(np.int64) << 3)
    rows = spark.createDataFrame([(7, -1, int(x)) for x in fp], "cell long, mask long, fp long")
    once = simhash._deal_raw(rows, 3)
    twice = simhash._deal_raw(once, 3).groupBy("cell", "mask").agg(F.collect_set("fp").alias("fps")).collect()
    met = {frozenset((a, b)) for row in twice for i, a in enumerate(row.fps) for b in row.fps[i + 1 :] if (a ^ b).bit_count() <= 3}
    want = {frozenset((int(a), int(b))) for i, a in enumerate(fp) for b in fp[i + 1 :] if (int(a) ^ int(b)).bit_count() <= 3}
    assert want <= met


@pytest.mark.parametrize("cell_rows", [1, 2, 5])
def test_near_fingerprints_in_small_cells_come_to_an_end(spark, cell_rows):
    """All 64 values of six bits, one cell throughout: more than ``cell_rows`` stay together when few bits are open."""
    far = [int(x) for x in np.random.default_rng(8).integers(0, 1 << 62, 5)]
    fp = [int(np.int64(sum((k >> b & 1) << at for b, at in enumerate((0, 1, 2, 30, 45, 62))))) for k in range(64)]
    rows = spark.createDataFrame([(x,) for x in [*fp, *far]], "fp long").repartition(4)
    got = [(r.u, r.v) for r in simhash.fingerprint_links(rows, 3, cell_rows=cell_rows).collect()]
    want = [(a, b) for i, a in enumerate([*fp, *far]) for b in [*fp, *far][i + 1 :] if (a ^ b).bit_count() <= 3]
    assert set(map(frozenset, got)) <= set(map(frozenset, want))
    assert _components([*fp, *far], got) == _components([*fp, *far], want)
