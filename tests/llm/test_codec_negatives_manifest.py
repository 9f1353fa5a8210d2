"""SentencePiece codec, hard negatives and the Merkle manifest against the library, SQL and brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from activitykit.llm import hard_negatives, merkle, piece_codec
from activitykit.llm.queries import llm_oracle_sql, llm_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


# -- SentencePiece ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def codec():
    return piece_codec.Codec()


def _texts():
    r = random.Random(5)
    odd = ["", " ", "  ", "a ", " a  b\n c\t", "\x00x", "a　b\xa0c", "▁x ▁", "x▁ y", "<s> </s> <unk> <0x41>", "ﬁ ① é", "�", "\n" * 30]
    long_ = [" " * 1000, " " * 50 + "foo" + " " * 17 + "bar", "a" * 5000, "ab" * 3000, "日本語のテキスト" * 100, "\U0001F600" * 10, "=" * 999, "ababab aaaa abcabc " * 400]
    mixed = ["".join(r.choice("abcdetins ▁ \n\t.=-_0123é日\U0001F600  ") for _ in range(r.randint(0, 300))) for _ in range(500)]
    return odd + long_ + mixed + ["".join(r.choice("aab  ") for _ in range(r.randint(0, 200))) for _ in range(500)]


def test_ids_and_texts_are_the_librarys(library, codec):
    texts = _texts()
    flat, counts = codec.encode(texts)
    ends = np.cumsum(counts)
    decoded = codec.decode(flat, counts)
    for text, end, n, back in zip(texts, ends, counts, decoded):
        want = library.encode(text)
        assert flat[end - n : end].tolist() == want, text[:60]
        assert back == library.decode(want) == text.replace("▁", " ")


def test_heap_finishes_what_rounds_leave(library, codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "ROUNDS", 2)
    for text in _texts()[:60]:
        codec._forget()
        assert codec.encode([text])[0].tolist() == library.encode(text)


def test_long_texts_go_part_by_part(library, codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "PART", 40)
    for text in _texts()[:60]:
        assert np.concatenate(list(codec.encode_one(text))).tolist() == library.encode(text)


@pytest.mark.parametrize("ids", [[], [1, 261, 2], [0, 5], [229, 133, 300], [229, 133, 175], [243, 162, 68], [259, 1, 259], [240, 163, 131], [2, 1]])
def test_decoding_any_ids(library, codec, ids):
    assert codec.decode(np.array(ids, np.int64), np.array([len(ids)])) == [library.decode(ids)]


def test_codec_columns_nulls_repeats_and_empty_table(spark, library):
    schema = "doc_id long, text string, `we ird` int, decoded string"
    rows = [(1, "some words here", 3, "x"), (1, "some words here", 3, "x"), (None, None, None, None), (2, "", 1, "y"), (3, "w" + " long" * 3000, 1, "z")]
    got = piece_codec.decoded(piece_codec.encoded(spark.createDataFrame(rows, schema))).collect()
    assert sorted((r.doc_id or 0, r.ids, r.decoded, r["we ird"] or 0) for r in got) == sorted((d or 0, library.encode(t or ""), t or "", w or 0) for d, t, w, _ in rows)
    assert piece_codec.encoded(spark.createDataFrame([], schema)).collect() == []


def test_op11_digests(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = llm_queries()["op11_sentencepiece"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# -- hard negatives --------------------------------------------------------------------------


def _mined(rows, positives=5, negatives=10, low=30, high=90):
    whole = {(i, l, tuple(v)) for i, v, l in rows if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    quantised = [(i, l, [int(np.floor(256 * x)) for x in v]) for i, l, v in sorted(whole)]
    out, asked = [], set()
    for i, l, v in quantised:
        if i % 100 or i in asked:
            continue
        asked.add(i)
        pairs = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in quantised if j != i and len(w) == len(v))
        for s, p, _ in [x for x in pairs if x[2] == l][:positives]:
            hit = [(n, j) for n, j, m in pairs if m != l and low * -s <= 100 * -n <= high * -s][:negatives]
            out += [(i, p, k, j, -s, -n) for k, (n, j) in enumerate(hit, 1)]
    return sorted(out)


def _vectors(n=700, seed=3):
    r = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in r.integers(-3, 6, 4) / 8], int(r.integers(0, 3))) for i in range(n)]  # few values: many ties
    rows += rows[:40] * 2  # repeated rows
    rows += [(100, [1.0, 0.5, 0.25, 0.0], 2), (None, [1.0, 1.0, 1.0, 1.0], 1), (901, None, 1), (902, [1.0, None, 1.0, 1.0], 1), (903, [float("nan"), 1.0, 1.0, 1.0], 1)]
    rows += [(904, [1.0, 1.0, 1.0, 1.0], None), (905, [0.5, 0.5], 1), (906, [float("inf"), 1.0, 1.0, 1.0], 1), (1000, [0.0] * 4, 0), (1100, [0.25, 0.5], 1), (907, [], 1)]
    return rows


@pytest.mark.parametrize("block_rows,part_anchors", [(4096, 2048), (50, 3)])
def test_hard_negatives_match_brute_force(spark, block_rows, part_anchors):
    rows = _vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, score string").repartition(5)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, block_rows=block_rows, part_anchors=part_anchors).collect()
    want = _mined(rows)
    assert len(want) > 100
    assert sorted(map(tuple, got)) == want


def test_one_anchor_spans_arrow_batches(spark):
    """The iterator goes on where a batch ends: windows stay open across batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = _vectors(300, 8)
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        assert sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 100 == 0, block_rows=64).collect())) == _mined(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_scores_past_a_double_are_exact_or_clipped(spark):
    rows = [(100, [3e15, 1.0], 1), (1, [3e15, 0.5], 1), (2, [1.5e15, 0.25], 2), (3, [-1e308, 0.5], 2), (200, [1e308, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert hard_negatives.mine(df, F.col("vec_id") == 100).collect() == []  # 9e35 lies past 64 bits: all clipped alike
    small = [(100, [2.0**22, 0.00390625], 1), (1, [2.0**22, 0.00390625], 1), (2, [2.0**21, 0.00390625], 2), (3, [2.0**21, 0.0078125], 2)]
    got = hard_negatives.mine(spark.createDataFrame(small, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 100).collect()
    assert sorted(map(tuple, got)) == _mined([(i, v, l) for i, v, l in small])


def test_hard_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect() == []


# -- Merkle manifest -------------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in merkle.FIELDS])


def _tree(digests):
    proofs, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for i, a in enumerate(at):
            proofs[i].append((level[a ^ 1], a & 1) if a ^ 1 < len(level) else None)
        at, level = [a >> 1 for a in at], [_h(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0], proofs


def _manifest(rows):
    leaves = [(r, _leaf(r)) for r in rows]
    trees = []
    for lang in sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode())):
        mine = sorted((x for x in leaves if x[0]["lang"] == lang), key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        trees.append((mine, *_tree([d for _, d in mine])))
    if not trees:
        return []
    root, tops = _tree([t[1] for t in trees])
    out = []
    for (mine, subroot, proofs), top in zip(trees, tops):
        for (row, leaf), proof in zip(mine, proofs):
            at, way = leaf, proof + top
            if row["doc_id"] is not None and row["n_chars"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0:
                at = _leaf({**row, "n_chars": row["n_chars"] + 1})
            for step in way:
                at = _h(at) if step is None else _h(step[0], at) if step[1] else _h(at, step[0])
            out.append((row["doc_id"], leaf, subroot, root, _h(*[s[0] for s in way if s]), at, at == root))
    return _sorted(out)


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


ROWS = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx long, digest string, proof string"


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, "a", "x", "s", 1)],
        [(7, None, None, None, None)],
        [(1, "a", "x", "s", 1), (2, "é", "y", None, None)],
        [(1, "a", "x", "s", 1)] * 5 + [(None, "", None, None, None)] * 3 + [(i, "t" * 50_000, "zé", "q", 2**63 - 1) for i in range(23)] + [(4, "u", "zé", "q", 1)],
        [(i, f"t{i}", f"lang{i}", "q", i) for i in range(9)],
    ],
    ids=["empty", "one", "nulls", "two trees", "mixed", "one row a tree"],
)
@pytest.mark.parametrize("top_nodes", [0, 16, 1 << 14])
def test_manifest_matches_brute_force(spark, monkeypatch, rows, top_nodes):
    if top_nodes == 0 and len(rows) > 30 or top_nodes == 16 and len(rows) < 30:
        pytest.skip("covered by another size")
    monkeypatch.setattr(merkle, "TOP_NODES", top_nodes)
    df = spark.createDataFrame([(*r, "t", 1, "d", "p") for r in rows], ROWS)
    df = df.repartition(4) if len(rows) > 20 else df
    names = ROWS.split(", ")[:5]
    assert _sorted(merkle.checked(df).collect()) == _manifest([dict(zip([n.split()[0] for n in names], r)) for r in rows])


def test_a_proof_alone_verifies_its_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = merkle.manifest(docs)
    assert found.filter(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert found.filter(merkle.folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).count() == 0


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_merkle_manifest"])
def test_queries_equal_their_sql(spark, name):
    got = llm_queries()[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.sql(llm_oracle_sql()[name])
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(str(type(got.first())(**dict(zip(want.columns, r)))) for r in want.fetchall())
