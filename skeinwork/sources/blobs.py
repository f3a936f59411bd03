"""Objects behind blob links: read as rows by Spark, written and looked for one at a time through the store's file system."""

from __future__ import annotations

import mimetypes
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def content_type(name: str) -> str:
    return mimetypes.guess_type(name)[0] or "application/octet-stream"


def read_blobs(spark: SparkSession, paths: list[str] | str, pattern: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content)"""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths)


def write_blob(spark: SparkSession, path: str, content: bytes) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    stream.write(bytearray(content))
    stream.close()
    return content_type(path)


def upload_file(spark: SparkSession, local: str, path: str, overwrite: bool = True) -> str:
    """Put a file of the driver's disk into the store, streamed by the file system's own client."""
    fs = spark._jvm.org.apache.hadoop.fs
    at = fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(False, overwrite, fs.Path(f"file://{os.path.abspath(local)}"), at)
    return content_type(path)


def blob_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def missing_blobs(records: DataFrame, blobs: DataFrame) -> DataFrame:
    """Links of blob_manifest that no object answers to, with the records that hold them."""
    links = records.select("id", F.explode("blob_manifest").alias("path"))
    return links.join(blobs.select("path"), "path", "left_anti")
