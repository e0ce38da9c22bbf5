"""A corpus pipeline over ``documents``: language identification, near-duplicate removal, benchmark decontamination,
removal of personal data, byte-level BPE encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; ``run`` writes
each stage's result as Parquet below the shared folder and reads it again for the next. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import bpe, decontamination, langid, near_dup, pii
from riskflow.llm.common import documents, materialize, parquet


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the centroids know; those that are too far from all, or have no letters, go."""
    return langid.accepted(docs, langid.fit(langid.training_rows(documents(spark, sf_dir))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) stays."""
    return near_dup.representatives(docs, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, parquet(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by placeholders, disclosing terms are generalised or removed; all documents stay."""
    return pii.sanitise(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, and whether decoding the ids gives the text back."""
    rows = bpe.encode(docs, *bpe.default_vocabulary())
    return rows.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("personal_data", personal_data),
    ("byte_bpe", tokens),
]

#: Clustering, sketches and merges cannot be stated in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
