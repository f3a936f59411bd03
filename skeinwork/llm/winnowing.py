"""Benchmark decontamination by winnowing: minimum k-gram hashes of sliding windows, joined and extended to whole windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_by_bytes, id_and_text, mix64, word_hashes, word_ids, write_table
from .ngrams import lowered, pieces

GRAM, SPAN, BATCH_BYTES = 5, 10, 4 << 20
#: Bits of the prefilter: 8 MB for each executor, fixed whatever the benchmark's size. A fuller filter lets more
#: fingerprints through to the join, which decides.
BITS = 1 << 26


def window_minima(hashes: np.ndarray, rows: np.ndarray, span: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of `span` words within a row: starts, the place of the smallest k-gram hash (the last of equal
    ones), and that hash as fingerprint.

    A window of span words holds span - k + 1 k-grams, and which one is kept follows from the window's words alone. So
    a window that two texts share gives both the same fingerprint at the same place in it: none is missed.
    """
    gram = min(gram, span)
    if len(hashes) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = len(hashes) - gram + 1
    grams = mix64(hashes[:last] ^ np.uint64(span))
    for k in range(1, gram):
        grams = mix64(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[k : last + k])
    starts = np.flatnonzero(rows[span - 1 :] == rows[: len(rows) - span + 1])
    best, place = grams[starts], starts.copy()
    for k in range(1, span - gram + 1):
        other = grams[starts + k]
        better = other <= best
        best, place = np.where(better, other, best), np.where(better, starts + k, place)
    return starts, place, best


@dataclass(frozen=True)
class Piece:
    """Words of rows of a table, or of a cut of one row that then begins with the last words of the cut before."""

    words: list[bytes]  # distinct ones
    ids: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray  # in the table
    places: np.ndarray  # the words' numbers within their rows
    new: int  # words not seen in the cut before


def word_pieces(column: pa.ChunkedArray, limit: int) -> Iterator[Piece]:
    tail: list[bytes] = []
    done = 0
    for data, bounds, first, on in pieces(column, limit):
        low, starts, ends, rows = lowered(data, bounds)
        ids, distinct = word_ids(low, starts, ends)
        words, hashes = distinct.to_pylist(), word_hashes(distinct)
        if not on:
            tail, done = [], 0
        held = np.arange(len(words), len(words) + len(tail))
        ids = np.concatenate([held, ids])
        hashes = np.concatenate([hashes, word_hashes(pa.array(tail, pa.large_binary()))])[ids] if len(ids) else np.zeros(0, np.uint64)
        rows = np.concatenate([np.zeros(len(tail), np.int64), rows])
        places = np.arange(len(rows)) - np.searchsorted(rows, rows) + done - len(tail)
        words += tail
        yield Piece(words, ids, hashes, rows + first, places, len(rows) - len(tail))
        done += len(rows) - len(tail)
        tail = [words[i] for i in ids[max(0, len(ids) - SPAN + 1) :]]


def _text(p: Piece, a: int, b: int) -> str:
    return b" ".join(p.words[i] for i in p.ids[a:b]).decode("utf-8", "replace")


def item_windows(items: DataFrame, batch_bytes: int = BATCH_BYTES, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, print, span, window) of each window of each item: SPAN words, or all of a shorter item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, batch_bytes):
            counts = np.zeros(table.num_rows, np.int64)
            for p in word_pieces(table.column("text"), batch_bytes):
                counts += np.bincount(p.rows[len(p.rows) - p.new :], minlength=len(counts))
            spans = np.minimum(counts, SPAN)
            items = table.column("item").to_pylist()
            for p in word_pieces(table.column("text"), batch_bytes):
                for span in np.unique(spans[p.rows]).tolist():
                    starts, _, prints = window_minima(p.hashes, p.rows, span)
                    own = spans[p.rows[starts]] == span
                    starts, prints = starts[own], prints[own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([items[r] for r in p.rows[starts]], pa.string()), pa.array(prints.view(np.int64)), pa.array(np.full(len(starts), span, np.int32)), pa.array([_text(p, a, a + span) for a in starts.tolist()], pa.string())],
                        ["item", "print", "span", "window"],
                    )

    rows = items.select(F.coalesce(items[id_col].cast("string"), F.lit("")).alias("item"), F.coalesce(items[text_col], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "item string, print long, span int, window string")


def _bit(prints: Column) -> Column:
    return F.pmod(prints, F.lit(BITS)) + 1


def prefilter(windows: DataFrame) -> np.ndarray:
    """A bitmap of BITS bits with those of the fingerprints set, made by an aggregate of 4 KB pieces."""
    at = windows.select(_bit(F.col("print")).alias("at"))
    got = at.groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()  # BITS / 32768 rows at most
    out = np.zeros(BITS // 8, np.uint8)
    for r in got:
        out[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def document_fingerprints(docs: DataFrame, spans: list[int], bits: np.ndarray, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A row for each document (row, doc_id, n_words), and one for each kept fingerprint that the prefilter knows:
    (row, print, span, start, words), the words of all windows that keep it there.

    row numbers documents, whatever their ids. Neighbouring windows mostly keep one fingerprint, so their words are
    given once; a document that shares nothing gives its own row alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # BITS / 8 bytes
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("print", pa.int64()), ("span", pa.int32()), ("start", pa.int64()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        base = TaskContext.get().partitionId() << 40
        for table in batches_by_bytes(batches, batch_bytes):
            n = table.num_rows
            counts, found = np.zeros(n, np.int64), []
            for p in word_pieces(table.column("text"), batch_bytes):
                counts += np.bincount(p.rows[len(p.rows) - p.new :], minlength=n)
                for span in spans:
                    starts, place, prints = window_minima(p.hashes, p.rows, span)
                    at = prints.view(np.int64) % BITS
                    keep = np.flatnonzero((known[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                    starts, place, prints = starts[keep], place[keep], prints[keep]
                    new = np.append(True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)) if len(starts) else np.zeros(0, bool)
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(starts)) - 1 if len(first) else first
                    for a, b, w in zip(starts[first].tolist(), starts[last].tolist(), prints[first].view(np.int64).tolist(), strict=True):
                        found.append((base + int(p.rows[a]), None, None, w, span, int(p.places[a]), _text(p, a, b + span)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(base, base + n)), table.column("doc_id").combine_chunks(), pa.array(counts), *[pa.nulls(n, f.type) for f in list(schema)[3:]]], schema=schema)
            for a in range(0, len(found), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found[a : a + 10_000], strict=True), schema, strict=True)], schema=schema)
            base += n

    return id_and_text(docs).mapInArrow(run, "row long, doc_id long, n_words long, print long, span int, start long, words string")


def hits(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, start, span, win): the windows of documents that are windows of items, word for word.

    Fingerprints are joined to the items' distinct ones; what is left is extended to all windows that keep it, and these
    are joined to the items' distinct windows by their text. So each join has one row a key on its small side, and a
    passage that many documents and many items share makes no pairs of these.
    """
    prints = windows.select("print").distinct()
    some = found.join(prints.hint("merge"), "print", "left_semi").withColumn("w", F.split("words", " "))
    texts = F.expr("transform(sequence(0, size(w) - span), i -> array_join(slice(w, i + 1, span), ' '))")
    each = some.select("row", "span", "start", "print", F.posexplode(texts).alias("k", "window"))
    return each.join(windows.select("print", "window", "win").hint("merge"), ["print", "window"]).select("row", (F.col("start") + F.col("k")).alias("start"), "span", "win")


def covered(found: DataFrame) -> DataFrame:
    """(row, n_hit): words within any hit window, from the windows in text order and how far those before reach."""
    order = Window.partitionBy("row").orderBy("start", "span")
    end = F.col("start") + F.col("span")
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumn("new", F.greatest(F.lit(0), end - F.greatest("start", before))).groupBy("row").agg(F.sum("new").alias("n_hit"))


def items_of(found: DataFrame, items: DataFrame) -> DataFrame:
    """(row, n_items, items_sha256). Rows that hold the same windows hold the same items, so these are gathered once for
    each set of windows (equal by 128 bits of hashes of the windows' numbers), not once for each document."""
    each = found.select("row", "win").distinct()
    sets = each.groupBy("row").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("win")).alias("h1"), F.bit_xor(F.xxhash64("win", F.lit(1))).alias("h2"))
    one = sets.groupBy("n", "h1", "h2").agg(F.min("row").alias("row"))
    own = each.join(one.select("row").hint("merge"), "row", "left_semi").join(items, "win").select("row", "item").distinct()
    lists = own.groupBy("row").agg(F.count("*").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("item"))), 256).alias("items_sha256"))
    return sets.join(one.join(lists, "row").drop("row").hint("merge"), ["n", "h1", "h2"]).select("row", "n_items", "items_sha256")


def decontaminate(docs: DataFrame, items: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of docs.

    Null and empty texts have no words: such documents are hit by nothing, and such items hit nothing. Items of under
    SPAN words are one window, found by fingerprints of windows of their own length. Repeated and null doc_ids are
    documents of their own; items of one id count once, a null item_id is "". Ties of hashes within a window go to the
    later k-gram, in documents and items alike. Empty tables give no rows, or rows without hits. Windows are equal by
    their words, not by hashes.
    """
    windows = item_windows(items, batch_bytes)
    each = write_table(windows.groupBy("print", "span", "window").agg(F.count("*").alias("n")).withColumn("win", F.monotonically_increasing_id()), "benchmark-windows")
    of_items = windows.select("item", "print", "window").distinct().join(each.select("print", "window", "win").hint("merge"), ["print", "window"]).select("win", "item")
    spans = sorted(r["span"] for r in each.select("span").distinct().collect())  # SPAN of them at most
    rows = write_table(document_fingerprints(docs, spans, prefilter(each), batch_bytes), "document-fingerprints")
    found = write_table(hits(rows.where("print is not null"), each), "benchmark-hits")
    known = covered(found).join(items_of(found, of_items), "row")
    out = rows.where("print is null").select("row", "doc_id", "n_words").join(known.hint("merge"), "row", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


ORACLE = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
bw as (select coalesce(item_id::varchar, '') item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
bx as (select item, least(len(w), 10) n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') for i in range(1, len(w) - least(len(w), 10) + 2)]) x from bw where len(w) > 0),
ds as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from dw, (select distinct n from bx) where len(w) >= n),
h as (select doc_id, i, n, x from (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') x from ds) where x in (select x from bx)),
p as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from h) group by doc_id),
t as (select doc_id, count(*) n_items, sha256(string_agg(item, ',' order by item)) items_sha256 from (select distinct doc_id, item from h join bx using (x)) group by doc_id)
select dw.doc_id, len(w)::bigint n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, coalesce(items_sha256, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from dw left join p using (doc_id) left join t using (doc_id)"""
