"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, filter_audit, mixing, near_dup, packing, paragraphs, prefix_free, quality, resampling, secrets, token_counts, token_files, winnowing
from .common import documents, shared_folder


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    llr = secrets.fit(secrets.labelled_samples(docs, labels))
    return secrets.find_secrets(docs, llr)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/skeinwork/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, path)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), model_path=public_tokenizers.path("piece_bpe_32k.model"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_free.removed_bytes(documents(spark, sf_dir))


def op10_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return paragraphs.summary(docs, paragraphs.repeated_paragraphs(docs))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_secrets, op2_exact_dedup, op3_quality, op4_near_dedup, op5_token_counts, op6_token_files, op7_mixing, op8_packing, op9_prefix_free, op10_paragraphs, op11_filter_audit, op12_resampling, op13_decontamination)}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.ORACLE, "op11_filter_audit": filter_audit.ORACLE, "op12_resampling": resampling.ORACLE, "op13_decontamination": winnowing.ORACLE}
