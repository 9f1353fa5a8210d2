"""Entropy balancing: the distributed Newton steps against a dense solver, and the rounding of document rates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from activitykit.llm import mixing


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def _table(spark):
    r = np.random.default_rng(9)
    rows = []
    for source, n, top in [("a", 300, 40), ("b", 60, 900), ("c", 25, 30), (None, 40, 200), ("hot", 900, 120), ("void", 5, 0)]:
        rows += [(int(len(rows) + i), " ".join(["w"] * int(k)), source) for i, k in enumerate(r.integers(0, top + 1, n))]
    rows += [(7000, "very long " * 4000, "b"), (7001, None, "a"), (7001, None, "a"), (None, "w w w", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def _solve(sizes: np.ndarray, target: float, budget=1.5, cap=2) -> np.ndarray:
    """The rates cap / (1 + exp(-(a + l z))) whose words are ``target``, by bisection on l."""
    z = sizes / sizes[sizes > 0].mean()
    a = np.log((budget / cap) / (1 - budget / cap))

    def rates(l):
        return cap / (1 + np.exp(np.clip(-(a + l * z), -700, 700)))

    low, high = -1.0, 1.0
    while rates(low) @ sizes > target:
        low *= 2
    while rates(high) @ sizes < target:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if rates(middle) @ sizes < target else (low, middle)
    return rates(low)


def test_rates_are_those_of_a_dense_solver(spark):
    rows = mixing.sized(_table(spark))
    targets = mixing.source_targets(rows)
    rated = mixing.rated(rows, mixing.balanced(rows, targets)).collect()
    met = 0
    for t in targets.collect():
        mine = [r for r in rated if r.source == t.source]
        sizes, rates = np.array([r.size for r in mine], float), np.array([r.rate for r in mine])
        assert (rates >= 0).all() and (rates <= 2).all()
        assert rates @ sizes == pytest.approx(t.target, rel=1e-6, abs=1e-6)
        if 0 < t.target < 2 * t.source_size * (1 - 1e-9):
            met += 1
            assert rates == pytest.approx(_solve(sizes, t.target), abs=1e-6)
            assert len(set(np.round(rates[sizes > 0], 6))) > 5  # a rate a document, not one a source
            by_size = rates[np.argsort(sizes, kind="stable")]
            assert (np.diff(by_size) <= 1e-12).all() or (np.diff(by_size) >= -1e-12).all()
    assert met >= 2


def test_copies_follow_the_rates_and_meet_the_targets(spark):
    docs = _table(spark)
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == docs.count()
    for source in {r.source for r in mixed}:
        mine = [r for r in mixed if r.source == source]
        longest = max(r.size for r in mine)
        assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= longest
        assert all(0 <= r.copies <= 2 for r in mine)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))
    rows = mixing.sized(docs)
    rated = mixing.rated(rows, mixing.balanced(rows, mixing.source_targets(rows)))
    off = rated.join(mixing.mix(docs).select("doc_id", "source", "copies"), ["doc_id", "source"]).where(F.abs(F.col("copies") - F.col("rate")) > 1.0 + 1e-9)
    assert off.count() <= 2 * mixing.FLIPS * 6  # only documents that a flip has moved


def test_no_words_and_no_rows(spark):
    docs = _table(spark)
    assert {r.copies * r.size for r in mixing.mix(docs.withColumn("text", F.lit(None).cast("string"))).collect()} == {0}
    assert mixing.mix(docs.filter("false")).count() == 0
