"""MinHash near-dedup: BagMinHash signatures of five-word shingle multisets, banded, verified by multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes, flat_bytes, hot_join, id_and_text, release, word_spans, write_table
from .links import classes
from .signatures import bag_minhash, band_keys, shingles

BANDS, ROWS = 24, 5  # a pair of similarity 0.8 shares a band with probability 0.99993
LEAST = 0.8
_SIGNED = pa.schema([("doc_id", pa.int64()), ("print", pa.binary()), ("n_shingles", pa.int64()), ("keys", pa.list_(pa.int64()))])
_CONTENT = pa.schema([("id", pa.int64()), ("elements", pa.list_(pa.int64())), ("weights", pa.list_(pa.int32()))])


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _rows(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return _lists(values.reshape(-1), np.arange(n + 1) * width, kind)


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, print, n_shingles, keys) of each document; print identifies its multiset of shingles, keys are its bands'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, 2 << 20):
            data, bounds = flat_bytes(table["text"])
            n = table.num_rows
            row, element, weight = shingles(data, *word_spans(data, bounds), n)
            sig = bag_minhash(row, element, weight, n, bands * rows)
            at = np.searchsorted(row, np.arange(n + 1))
            both = np.stack([element, weight.astype(np.uint64)], axis=1)
            prints = [xxhash.xxh3_128_digest(both[a:b].tobytes()) if b > a else None for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            total = np.bincount(row, weight, n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(prints, pa.binary()), pa.array(total), _rows(band_keys(sig, bands), pa.int64())], schema=_SIGNED)

    return docs.mapInArrow(run, "doc_id long, print binary, n_shingles long, keys array<long>")


def content(docs: DataFrame) -> DataFrame:
    """(id, elements, weights): the multiset of shingles of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, 2 << 20):
            data, bounds = flat_bytes(table["text"])
            row, element, weight = shingles(data, *word_spans(data, bounds), table.num_rows)
            at = np.searchsorted(row, np.arange(table.num_rows + 1))
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), _lists(element.astype(np.int64), at, pa.int64()), _lists(weight, at, pa.int32())], schema=_CONTENT)

    return docs.mapInArrow(run, "id long, elements array<long>, weights array<int>")


def near_duplicates(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS, sketches: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, kept, n_shingles.

    A class is a component of the links between documents whose multisets of five-word shingles have a weighted Jaccard
    similarity of `least` or more; class_id is its smallest doc_id, which is the one kept. Documents with one multiset
    are one class at once and enter the search as one. A text of one to four words is one shingle; null and empty texts
    are each alone. Rows with a null id are each alone, with a null class_id, and are kept. Repeated rows share a class.
    """
    base = id_and_text(docs, id_col, text_col)
    marked = write_table(signed(base, bands, rows), "signatures")
    same = marked.where("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    same = write_table(same, "same-prints")
    known = hot_join(marked, same, "print", "left").withColumn("rep", F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("rep", "doc_id")))
    known = write_table(known.select("doc_id", "rep", "print", "n_shingles", "keys"), "signed")
    release(marked, same)
    reps = known.where("doc_id = rep and print is not null").select(F.col("doc_id").alias("id"), "keys").distinct()

    def of(ids: DataFrame) -> DataFrame:
        # a merge join at every size: a few ids would be broadcast, many would not, and the plan should not depend on it
        # and rows repeated under one id go while they lie by id, before their shingles make them larger
        return content(base.join(ids.hint("merge"), base.doc_id == ids.id, "left_semi").distinct())

    labels, contents = classes(reps, of, least, sketches)
    sizes = known.groupBy("rep").agg(F.count("*").alias("n"))
    out = hot_join(known.select("doc_id", "rep", "n_shingles"), labels.withColumnRenamed("id", "rep"), "rep", "left", sizes=sizes)
    out = write_table(out.select("doc_id", F.coalesce("label", "rep").alias("class_id"), "n_shingles"), "near-classes")
    release(known, contents)
    sizes = write_table(out.groupBy("class_id").agg(F.count("*").alias("class_size")).where("class_size > 1 and class_id is not null"), "class-sizes")
    out = hot_join(out, sizes, "class_id", "left", "class_size")
    return out.select("doc_id", "class_id", F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"), "n_shingles")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: of each class the row with the smallest id (null ids last).

    Rows are told apart by a key of their own, written with them, so near copies under one id or without an id meet too.
    """
    keyed = write_table(docs.withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    classes_of = near_duplicates(keyed, id_col="__row", text_col=text_col).where("class_size > 1").select(F.col("doc_id").alias("__member"), "class_id")
    members = write_table(classes_of.join(keyed.select("__row", keyed[id_col].cast("long").alias("id")), F.col("__member") == F.col("__row")).select("__member", "class_id", F.struct(F.col("id").isNull().alias("none"), "id", F.col("__member").alias("row")).alias("place")), "near-members")
    stay = members.groupBy("class_id").agg(F.min("place")["row"].alias("__stays")).select("__stays")
    gone = members.select("__member").join(stay, F.col("__member") == F.col("__stays"), "left_anti")
    return keyed.join(gone, keyed["__row"] == gone["__member"], "left_anti").select(*[keyed[c] for c in docs.columns])
