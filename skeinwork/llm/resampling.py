"""Importance resampling towards a target: hashed word and pair counts, a gain for each bucket, Gumbel top-k."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_by_bytes, id_and_text, write_table
from .ngrams import feature_crcs, pieces

BUCKETS, BATCH_BYTES = 10_000, 4 << 20


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """How many features of all texts fall into each bucket; null texts have none, and no rows give zeros.

    Each task gives one vector of `buckets` numbers, and treeReduce adds these up in steps, so that what meets in one
    place (a task or the driver) is a few vectors, whatever the number of tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for table in batches_by_bytes(batches, batch_bytes):
            before = None
            for data, bounds, _, on in pieces(table.column("text"), batch_bytes):
                _, crcs, _, before = feature_crcs(data, bounds, before if on else None)
                total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    vectors = texts.select(texts[text_col].alias("text")).mapInArrow(run, "counts binary").rdd.map(lambda r: np.frombuffer(r[0], np.int64))
    return vectors.treeReduce(np.add, depth=3) if vectors.getNumPartitions() else np.zeros(buckets, np.int64)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's smoothed shares in target and source, floored."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """1000 times a Gumbel number that the id alone decides, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 7, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row: the floored mean of its features' gains, and that with noise."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket, so its size is fixed
    fields = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for table in batches_by_bytes(batches, batch_bytes):
            n, total, words, before = table.num_rows, np.zeros(table.num_rows), np.zeros(table.num_rows, np.int64), None
            features = np.zeros(n, np.int64)
            for data, bounds, first, on in pieces(table.column("text"), batch_bytes):
                rows, crcs, count, before = feature_crcs(data, bounds, before if on else None)
                here = slice(first, first + len(bounds) - 1)
                total[here] += np.bincount(rows, gain[crcs % np.uint32(len(gain))], len(bounds) - 1)  # whole numbers under 2**53: exact
                features[here] += np.bincount(rows, minlength=len(bounds) - 1)
                words[here] += count
            weight = np.where(features > 0, total.astype(np.int64) // np.maximum(features, 1), 0)
            ids = table.column("doc_id").to_pylist()
            score = weight + np.fromiter((gumbel(i, seed) for i in ids), np.int64, n)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(x, pa.int64()) for x in (words, features, weight, score)]], fields)

    return id_and_text(docs).mapInArrow(run, ", ".join(f"{f} long" for f in fields))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, target_text: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of docs; rank is null for those that are not drawn.

    Of the N rows with min_words words or more, the floor(percent * N / 100) of the highest scores are drawn; ties go to
    the smaller doc_id, null ids last, and repeated ids in the order of their rows. Null and empty texts have no
    features, weight 0, and are never drawn. Empty tables give no rows; an empty target gives equal counts of nothing.
    Ranks come from ranges of the order and the ranges' counts; no task sees more than a range.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, batch_bytes=batch_bytes), bucket_counts(target, target_text, batch_bytes=batch_bytes))
    rows = write_table(scored(docs, gain, seed, batch_bytes).withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    able = F.col("n_words") >= min_words
    draw = percent * rows.where(able).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = write_table(rows.where(able).repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "resampling-ranges")
    counts = ranged.groupBy("part").count().collect()  # a row for each range
    at, before = 0, []
    for part, n in sorted((r["part"], r["count"]) for r in counts):
        before.append((part, at))
        at += n
    starts = F.broadcast(spark.createDataFrame([(p, b) for p, b in before if b < draw], "part int, before long"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    columns = ["doc_id", "n_features", "weight", "score"]
    top = ranged.join(starts, "part").withColumn("rank", place).select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).cast("long").alias("rank"))
    rest = ranged.join(starts, "part", "left_anti").select(*columns, F.lit(None).cast("long").alias("rank"))
    return top.unionByName(rest).unionByName(rows.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


#: CRC-32 as a fold over a feature's bytes, with the table made from its polynomial.
ORACLE = r"""
with recursive bits as (select range::ubigint b, range::ubigint c, 0 k from range(256)
  union all select b, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end, k + 1 from bits where k < 8),
tbl as (select list(c order by b) t from bits where k = 8),
dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
bw as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
df as (select doc_id, unnest(w || [w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) f from dw),
dn as (select doc_id, f, count(*) n from df group by doc_id, f),
bn as (select f, count(*) n from (select unnest(w || [w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) f from bw) group by f),
fs as (select distinct f from dn union select f from bn),
crc as (select f, (xor(list_reduce([4294967295::ubigint] || [('0x' || substr(hex(f), 2 * i - 1, 2))::ubigint for i in range(1, strlen(f) + 1)], lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::int + 1])), 4294967295::ubigint) % 10000)::bigint b from fs, tbl),
s as (select b, sum(n) n from dn join crc using (f) group by b),
t as (select b, sum(n) n from bn join crc using (f) group by b),
g as (select range b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from s) + 10000)::double / ((coalesce(s.n, 0) + 1)::double * ((select coalesce(sum(n), 0) from t) + 10000)::double)))::bigint gain
  from range(10000) left join s on s.b = range left join t on t.b = range),
d as (select doc_id, sum(n)::bigint n, floor(sum(n * gain)::double / sum(n))::bigint weight from dn join crc using (f) join g using (b) group by doc_id),
r as (select dw.doc_id, len(w) n_words, coalesce(d.n, 0) n_features, coalesce(weight, 0) weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || dw.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double))))::bigint score from dw left join d using (doc_id)),
o as (select doc_id, row_number() over (order by score desc, doc_id) k, count(*) over () n from r where n_words >= 20)
select r.doc_id, n_features, weight, score, case when k <= 25 * n // 100 then k end "rank" from r left join o using (doc_id)"""
