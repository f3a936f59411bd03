"""Token-id files: documents' ids in ascending id order, coded in checksummed blocks by an adaptive range coder.

File format. A folder of Parquet files is the container, so Spark's own commit, retries and remote stores apply. A row
is a frame: the ids of a run of whole documents (about frame_ids ids, or one longer document), end to end, cut into
blocks of `block` ids that decode alone.

    part, frame   place: task that wrote it, and number within it
    n_tokens      ids in the frame
    doc_ids, doc_tokens   the documents and how many ids each has, in order
    block         ids in a block
    blocks, sums  each block's bytes (see range_coder) and the CRC-32 of its ids as little-endian uint16
Frames in order of (first doc_id, part, frame) hold all ids in ascending doc_id order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches_by_bytes, id_and_text, shuffle_cleanup
from .range_coder import BLOCK, decode, encode
from .tokens import word_bpe_ids

SCHEMA = "part int, frame int, first_id long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, block int, blocks array<binary>, sums array<long>"
_FIELDS = pa.schema([("part", pa.int32()), ("frame", pa.int32()), ("first_id", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("block", pa.int32()), ("blocks", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64()))])
READ = "doc_id long, part int, frame int, place int, before long, n_tokens long, ids_crc32 long"
_READ = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("frame", pa.int32()), ("place", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, frame_ids: int = 6_000_000, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append end_id to each document, and write frames in ascending id order to `path`.

    One range shuffle of the texts; each task then streams its documents, holding one frame at a time. A null or empty
    text is its end id alone; null ids come first; rows that repeat an id are written one after another. An empty table
    gives a folder without frames.
    """

    def frame(part: int, number: int, doc_ids: list, ids: list[np.ndarray], sizes: list[int]) -> pa.RecordBatch:
        flat = np.concatenate(ids)
        parts = encode(flat, block)
        sums = [zlib.crc32(flat[k : k + block].astype("<u2")) for k in range(0, len(flat), block)]
        row = {"part": part, "frame": number, "first_id": doc_ids[0], "n_tokens": len(flat), "doc_ids": doc_ids, "doc_tokens": sizes, "block": block, "blocks": parts, "sums": sums}
        return pa.RecordBatch.from_pylist([row], schema=_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, doc_ids, ids, sizes = TaskContext.get().partitionId(), 0, 0, [], [], []
        for table in batches_by_bytes(batches, 8 << 20):
            flat, bounds = word_bpe_ids(table["text"], tokenizer_path)
            for k, doc_id in enumerate(table["doc_id"].to_pylist()):
                own = np.append(flat[bounds[k] : bounds[k + 1]], np.uint16(end_id))
                if held and held + len(own) > frame_ids:
                    yield frame(part, number, doc_ids, ids, sizes)
                    number, held, doc_ids, ids, sizes = number + 1, 0, [], [], []
                doc_ids.append(doc_id)
                ids.append(own)
                sizes.append(len(own))
                held += len(own)
        if held:
            yield frame(part, number, doc_ids, ids, sizes)

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    with shuffle_cleanup(docs.sparkSession):
        ordered.mapInArrow(run, SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Every block is decoded and its checksum compared; a wrong one raises. The running total over all files comes from
    the frames' sizes alone: a window over the parts' totals and one within each part, never over documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                ids = decode(one["blocks"], one["n_tokens"], one["block"])
                for k, want in enumerate(one["sums"]):
                    if zlib.crc32(ids[k * one["block"] : (k + 1) * one["block"]].astype("<u2")) != want:
                        raise ValueError(f"part {one['part']}, frame {one['frame']}, block {k}: wrong checksum")
                size = np.array(one["doc_tokens"], np.int64)
                ends = np.cumsum(size)
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[e - n : e]) for e, n in zip(ends.tolist(), size.tolist(), strict=True)]
                n = len(size)
                yield pa.RecordBatch.from_arrays([pa.array(one["doc_ids"], pa.int64()), pa.array(np.full(n, one["part"], np.int32)), pa.array(np.full(n, one["frame"], np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(ends - size), pa.array(size), pa.array(crc, pa.int64())], schema=_READ)

    files = spark.read.schema(SCHEMA).parquet(path)
    rows = files.select("part", "frame", "n_tokens", "doc_ids", "doc_tokens", "block", "blocks", "sums").mapInArrow(run, READ)
    index = files.select("part", "frame", "first_id", "n_tokens")
    parts = index.groupBy("part").agg(F.min_by("first_id", "frame").alias("first_id"), F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.asc_nulls_first("first_id"), "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before_part"))
    within = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    frames = index.withColumn("before_frame", within).join(parts, "part").select("part", "frame", (F.col("before_part") + F.col("before_frame")).alias("base"))
    return rows.join(frames, ["part", "frame"]).select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
