"""The registered queries of the text operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.llm import hard_negatives, langid_ppm, license_scan, lm_trie, merkle, mixing, nearest, packing, piece_codec, quality_llr, simhash, substring_dedup, suffix_dedup
from activitykit.llm.common import crc_mod, documents


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause dedup of all documents: counts, removed offsets and the text that stays."""
    return substring_dedup.clean(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_units", "n_removed", "removed_spans", "text")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents outside the held-out seventh, scores all."""
    return lm_trie.score(documents(spark, sf_dir), crc_mod("doc_id", 7) == 2)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of repeated 400-byte strings go, the first too. ``text``: what stays, a character cut in two shown as U+FFFD."""
    found = suffix_dedup.clean(documents(spark, sf_dir), keep_first=False)
    n_removed = (F.col("n_bytes") - F.length("kept")).cast("long")
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        spans.alias("removed_spans"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every vec_id divisible by 20, against all other rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_llr.quality(docs, quality_llr.fit_weights(docs, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents outside the held-out third, predicts all."""
    docs = documents(spark, sf_dir)
    held_out = crc_mod("doc_id", 3) == 1
    model = langid_ppm.PpmModel(langid_ppm.training_sample(docs, ~held_out))
    return langid_ppm.identify(docs, model, held_out)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded; ids and texts as digests."""
    coded = piece_codec.decoded(piece_codec.encoded(documents(spark, sf_dir).select("doc_id", "text")).drop("text"))
    spelled = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every vec_id divisible by 100, against all other rows; every seventh label is shifted first."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, verified against the tampered copy."""
    return merkle.checked(documents(spark, sf_dir))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_license_scan": op4_license_scan,
        "op5_nearest": op5_nearest,
        "op6_quality_rules": op6_quality_rules,
        "op7_mixing": op7_mixing,
        "op8_packing": op8_packing,
        "op9_simhash": op9_simhash,
        "op10_language_id": op10_language_id,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def llm_oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substring_dedup.CLEAN_SQL,
        "op4_license_scan": license_scan.scan_sql(),
        "op12_hard_negatives": hard_negatives.MINE_SQL,
        "op13_merkle_manifest": merkle.CHECKED_SQL,
    }
