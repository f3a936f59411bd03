"""A corpus pipeline over documents: each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skeinwork.llm.common import documents, scratch, shared_folder
from skeinwork.llm.exact_dedup import drop_exact_duplicates
from skeinwork.llm.mixing import mixed_documents
from skeinwork.llm.near_dup import drop_near_duplicates
from skeinwork.llm.packing import pack
from skeinwork.llm.quality import keep_good


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules; null and empty texts don't, repeated rows are judged each."""
    return keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts; null counts as empty, ties go to the smallest doc_id."""
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies; rows without a word are each alone, ties go to the smallest doc_id."""
    return drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix uses them, in its order; sources without a token give none."""
    return mixed_documents(docs, model_path=public_tokenizers.path("piece_bpe_32k.model"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences; a null or empty text is its end id."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_stage), ("exact dedup", exact_stage), ("near dedup", near_stage), ("mixing", mixing_stage), ("packing", packing_stage)]
ORACLE_SQL = None  # compression, signatures and tokens are beyond SQL; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences of all documents that stay (see packing.pack); no rows for an empty table.

    Null and empty texts fail the quality rules. Of repeated and near rows one stays, as the stages say. Extra columns of
    documents go along up to packing.
    """
    docs, base = documents(spark, sf_dir), f"{shared_folder(spark)}/skeinwork/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
