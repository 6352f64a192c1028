"""A corpus pipeline of five operators: documents in, token ids of the kept ones out.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and gives a DataFrame; ``run`` writes each to the shared folder as Parquet
and reads it again. All stages but the last keep the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telvault.llm import bpe, decontamination, quality_rules, simhash, toxicity
from telvault.llm.common import shared_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no quality rule."""
    return quality_rules.kept_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.one_of_each(docs, "doc_id", "text")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark windows."""
    return decontamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded bytes."""
    return bpe.tokens(docs, "doc_id", "text")


STAGES = [
    ("quality_rules", quality),
    ("toxicity", not_toxic),
    ("simhash_dedup", without_near_copies),
    ("decontamination", decontaminated),
    ("bpe", tokenized),
]

#: The toxicity model and the fingerprints have no SQL form: tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
