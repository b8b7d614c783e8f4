"""From raw documents to packed sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partloom.llm import best_fit_packing, compression_toxicity, paragraph_minhash, quality_rules, simhash_trie
from partloom.llm.common import stored, work_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    model = compression_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression_toxicity.reject(docs, model)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps."""
    return quality_rules.keep_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_trie.keep_first(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the paragraphs that other documents, or the text itself, have before."""
    return paragraph_minhash.remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return best_fit_packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality),
    ("simhash near-dedup", near_copies),
    ("substring dedup", repeats),
    ("best-fit packing", packing),
]

#: No single SQL statement says what the stages do; the tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return docs
