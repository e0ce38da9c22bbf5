"""The registered queries of the training-data operators, and their DuckDB texts where SQL can express them."""

from __future__ import annotations

from riskflow.llm import (
    bpe,
    centroids,
    decontamination,
    langid,
    merkle,
    near_dup,
    packing,
    pii,
    quality,
    sharding,
    suffix_dedup,
    toxicity,
    warc,
)
from riskflow.llm.common import documents, parquet

QUERIES = {
    "op1_toxic_segments": lambda spark, sf_dir: toxicity.op1(documents(spark, sf_dir), parquet(spark, sf_dir, "labels")),
    "op2_byte_bpe": lambda spark, sf_dir: bpe.op2(documents(spark, sf_dir)),
    "op3_sharding": lambda spark, sf_dir: sharding.op3(documents(spark, sf_dir)),
    "op4_suffix_dedup": lambda spark, sf_dir: suffix_dedup.op4(documents(spark, sf_dir)),
    "op5_warc_index": lambda spark, sf_dir: warc.op5(parquet(spark, sf_dir, "pages")),
    "op6_benchmark_leaks": lambda spark, sf_dir: decontamination.op6(documents(spark, sf_dir), parquet(spark, sf_dir, "benchmark")),
    "op7_language_id": lambda spark, sf_dir: langid.op7(documents(spark, sf_dir)),
    "op8_quality_forest": lambda spark, sf_dir: quality.op8(documents(spark, sf_dir), parquet(spark, sf_dir, "labels")),
    "op9_near_duplicates": lambda spark, sf_dir: near_dup.op9(documents(spark, sf_dir)),
    "op10_personal_data": lambda spark, sf_dir: pii.op10(documents(spark, sf_dir)),
    "op11_orchard_clusters": lambda spark, sf_dir: centroids.op11(parquet(spark, sf_dir, "embeddings")),
    "op12_merkle_manifest": lambda spark, sf_dir: merkle.op12(documents(spark, sf_dir)),
    "op13_mixture_packing": lambda spark, sf_dir: packing.op13(documents(spark, sf_dir)),
}

ORACLES = {
    "op3_sharding": sharding.ORACLE,
    "op4_suffix_dedup": suffix_dedup.ORACLE,
    "op5_warc_index": warc.ORACLE,
    "op9_near_duplicates": near_dup.ORACLE,
    "op11_orchard_clusters": centroids.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
