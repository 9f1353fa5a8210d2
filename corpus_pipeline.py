"""The corpus pipeline: documents in, packed sequences out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
``run`` writes every stage's rows as Parquet in the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from activitykit.llm import mixing, packing, quality_llr, simhash, substring_dedup
from activitykit.runtime import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold; the raw counts are of ``docs``."""
    weights = quality_llr.fit_weights(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_llr.quality(docs, weights, keep_columns=True)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occurred earlier are cut from the texts; n_chars follows the new text."""
    return substring_dedup.clean(docs).selectExpr(*["length(text) n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns]).to(docs.schema)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source mix takes it."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces with their sequence and offset."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: BPE ids and fingerprints have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
