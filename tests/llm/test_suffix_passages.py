"""Planted passages of over 50 words, read from the query's own columns."""

import numpy as np
import pytest

from activitykit.llm.queries import llm_queries
from activitykit.llm.suffix_dedup import MIN_BYTES


def _words(seed: int, n: int, length: int) -> str:
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    return " ".join("".join(w) for w in letters[np.random.default_rng(seed).integers(0, 26, (n, length))])


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    """Documents 0 to 29 share a passage of 57 to 113 words by threes, 30 to 49 one of 55 words, 50 to 99 none."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    sf = str(tmp_path_factory.mktemp("sf"))
    long = [_words(1000 + i, 57 + 6 * i, 7) for i in range(10)]
    short = [_words(2000 + i, 55, 6) for i in range(10)]
    assert all(len(p) >= MIN_BYTES for p in long) and all(len(p) < MIN_BYTES - 2 for p in short)
    planted = [long[i // 3] for i in range(30)] + [short[i // 2] for i in range(20)] + [""] * 50
    texts = {i: f"{_words(i, 20 + i, 5)}|{i:03d}|{p}|{99 - i:03d}|{_words(500 + i, 119 - i, 5)}" for i, p in enumerate(planted)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4).write.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in llm_queries()["op3_suffix_dedup"](spark, sf).collect()}
    return texts, dict(enumerate(planted)), rows


def test_passages_of_400_bytes_go_from_every_document(found):
    texts, planted, rows = found
    for i in range(30):
        assert planted[i] not in rows[i].text
        assert rows[i].n_removed >= len(planted[i]) and rows[i].n_spans == 1
        assert rows[i].text.startswith(texts[i][:100]) and rows[i].text.endswith(texts[i][-100:])


def test_shorter_passages_and_clean_documents_are_left_alone(found):
    texts, _, rows = found
    assert all(rows[i].n_removed == rows[i].n_spans == 0 and rows[i].text == texts[i] for i in range(30, 100))


def test_n_bytes_is_the_size_before_removal(found):
    texts, _, rows = found
    assert {i: r.n_bytes for i, r in rows.items()} == {i: len(t) for i, t in texts.items()}
