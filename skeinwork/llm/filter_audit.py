"""How five filters interact: signed parity sums of failure masks, inverted to mask cells, read for all orders."""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes, flat_bytes, word_ids, word_spans, write_table

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
SYMBOLS = "#$%&*|"
_DUPLICATE = 1 << FILTERS.index("E")


def text_failures(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bits of A to D for each row of a batch, from its UTF-8 bytes."""
    n = len(bounds) - 1
    starts, ends, rows = word_spans(data, bounds)
    ids, distinct = word_ids(data, starts, ends)
    words = np.bincount(rows, minlength=n)
    kinds = np.bincount(np.unique(rows * max(1, len(distinct)) + ids) // max(1, len(distinct)), minlength=n)

    def count(is_one: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(is_one, out=sums[1:])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    fails = (words < 50, 100 * kinds < 65 * words, 100 * count((data >= 65) & (data <= 90)) > 5 * count((data & 0xC0) != 0x80), count(symbol[data]) > 0)
    return sum(f.astype(np.int64) << k for k, f in enumerate(fails))


def failure_masks(docs: DataFrame, batch_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, part, print, mask) of each row: the bits of A to D, and a SHA-256 of the text to find equal ones by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, batch_bytes):
            data, bounds = flat_bytes(table.column("text"))
            view, at = memoryview(np.ascontiguousarray(data)), bounds.tolist()
            prints = [hashlib.sha256(view[a:b]).digest() for a, b in itertools.pairwise(at)]
            columns = [table.column("doc_id").combine_chunks(), table.column("part").combine_chunks(), pa.array(prints, pa.binary()), pa.array(text_failures(data, bounds).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "print", "mask"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["source"], F.lit("")).alias("part"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, print binary, mask int")


def with_duplicates(masks: DataFrame) -> DataFrame:
    """masks with E's bit: the text is that of a smaller doc_id. Null ids are neither smaller nor greater than any."""
    first = masks.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("doc_id")).select("print", "doc_id", F.lit(True).alias("first"))
    fails = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return masks.join(first.hint("merge"), ["print", "doc_id"], "left").withColumn("mask", F.col("mask") + F.when(fails, _DUPLICATE).otherwise(0)).drop("first", "print")


def parity_sums(masks: DataFrame) -> DataFrame:
    """(part, label, sums): for each set s of filters, the documents that fail an even number of s less those that fail an odd one.

    All sums are of one aggregate, so a hot part is combined before it is shuffled.
    """
    signed = [F.sum(1 - 2 * F.bit_count(F.col("mask").bitwiseAND(F.lit(s))).bitwiseAND(F.lit(1))).alias(f"s{s}") for s in range(MASKS)]
    return masks.groupBy("part", "label").agg(*signed).select("part", "label", F.array(*[f"s{s}" for s in range(MASKS)]).alias("sums"))


def mask_cells(sums: DataFrame) -> DataFrame:
    """(part, label, cells): documents of each mask. The transform is its own inverse but for the factor, so all sums divide exactly."""
    cell = "aggregate(sequence(0, {n}), 0L, (a, s) -> a + sums[s] * (1 - 2 * (bit_count(m & s) & 1))) div {N}".format(n=MASKS - 1, N=MASKS)
    return sums.select("part", "label", F.expr(f"transform(sequence(0, {MASKS - 1}), m -> {cell})").alias("cells"))


def _steps() -> str:
    """All orders' steps as JSON: the filter's bit and those of the filters before it."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    return json.dumps([{"filter_order": "".join(o), "step": k + 1, "bit": bit[f], "before": sum(bit[g] for g in o[:k])} for o in itertools.permutations(FILTERS) for k, f in enumerate(o)])


def order_report(cells: DataFrame) -> DataFrame:
    """One row per part, order and step, read from a part's cells alone."""
    own = [F.sum(F.expr(f"if({label}, cells[{m}], 0L)")).alias(f"{name}{m}") for name, label in (("n", "true"), ("good", "label in (1, 3)"), ("toxic", "label in (2, 3)")) for m in range(MASKS)]
    cell = F.array(*[F.struct(F.lit(m).alias("m"), *[F.col(f"{c}{m}").alias(c) for c in ("n", "good", "toxic")]) for m in range(MASKS)])
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    rows = cells.groupBy("part").agg(*own).select("part", cell.alias("cells")).select("part", "cells", F.inline(steps))

    def total(which: str, what: str = "c.n") -> Column:
        return F.expr(f"aggregate(cells, 0L, (a, c) -> a + if({which}, {what}, 0L))")

    here = "(c.m & bit) <> 0 and (c.m & before) = 0"
    orders = len(list(itertools.permutations(FILTERS)))
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("(c.m & (before | bit)) = 0").alias("kept"),
        total(here).alias("removed"),
        total("(c.m & bit) <> 0 and (c.m & before) <> 0").alias("redundant"),
        total("c.m = bit").alias("unique_fails"),
        total(here, "c.good").alias("good_lost"),
        total(here, "c.toxic").alias("toxic_lost"),
        # of the orders in which a document comes, each filter it fails is the first of these in an equal share
        total("(c.m & bit) <> 0", f"c.n * ({orders} div bit_count(c.m))").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts for each part (source; null: ""), order of the five filters and step, with zeros.

    A null text is empty: it fails A, and E if a smaller doc_id's text is empty or null too. Repeated rows count each;
    those of one doc_id don't make each other fail E. Of several labels for a doc_id, any that says quality 1 or toxic 1
    counts; null ids and null labels have none. No documents give no rows. Extra columns are left alone.
    """
    label = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))).alias("label"))
    masks = with_duplicates(write_table(failure_masks(docs), "audit-masks"))
    labelled = masks.join(label.hint("merge"), "doc_id", "left").select("part", F.coalesce("label", F.lit(0)).alias("label"), "mask")
    return order_report(mask_cells(parity_sums(labelled)))


ORACLE = r"""
with d as (select doc_id, coalesce(source, '') part, coalesce(text, '') t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws from d),
f as (select w.doc_id, part, (len(ws) < 50)::int + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::int + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::int
  + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * (w.doc_id > min(w.doc_id) over (partition by t))::int m, coalesce(quality = 1, false) good, coalesce(toxic = 1, false) toxic
  from w left join labels l on l.doc_id = w.doc_id),
c as (select part, m, count(*) n, count_if(good) good, count_if(toxic) toxic from f group by part, m),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) x, unnest([1, 2, 4, 8, 16]) b),
o as (select l1.x || l2.x || l3.x || l4.x || l5.x filter_order, [l1.b, l2.b, l3.b, l4.b, l5.b] bs from l l1, l l2, l l3, l l4, l l5 where l1.b + l2.b + l3.b + l4.b + l5.b = 31 and (l1.b | l2.b | l3.b | l4.b | l5.b) = 31),
s as (select filter_order, step::int step, bs[step] b, list_sum([0] || bs[1:step - 1])::int p from o, range(1, 6) r(step)),
sh as (select part, b, sum(n * 120 // bit_count(m)) shapley from c, l where m & b > 0 group by part, b)
select c.part, filter_order, step, sum(case when m & (b | p) = 0 then n else 0 end)::bigint kept, sum(case when m & b > 0 and m & p = 0 then n else 0 end)::bigint removed,
 sum(case when m & b > 0 and m & p > 0 then n else 0 end)::bigint redundant, sum(case when m = b then n else 0 end)::bigint unique_fails,
 sum(case when m & b > 0 and m & p = 0 then good else 0 end)::bigint good_lost, sum(case when m & b > 0 and m & p = 0 then toxic else 0 end)::bigint toxic_lost,
 coalesce(any_value(sh.shapley), 0)::bigint shapley
from c cross join s left join sh using (part, b) group by c.part, filter_order, step"""
