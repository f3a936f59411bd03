"""Quality rules: compression bands (zstandard over whole texts and fixed chunks) beside plain word rules."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes, flat_bytes, id_and_text, word_ids, word_spans

SYMBOLS = "#*$%&|<>"


#: (least bytes, least ratio, most ratio): by size class, the range of the documents labelled good (sf0.1, 3,409 of them,
#: four languages) and about 6% beyond either end. None is over 64 KB; from there on the row is carried on, and wider.
ROWS = (
    (0, 0.0, 1.75),
    (256, 1.27, 1.77),
    (384, 1.34, 1.96),
    (512, 1.38, 2.01),
    (768, 1.52, 2.1),
    (1024, 1.63, 2.17),
    (1536, 1.73, 2.28),
    (2048, 1.81, 2.3),
    (3072, 1.9, 2.36),
    (4096, 2.0, 2.48),
    (8192, 2.1, 2.56),
    (16384, 2.2, 2.65),
    (65536, 2.25, 2.95),
    (262144, 2.25, 3.3),
)
#: The same of the chunks (2,048 bytes or more) of documents labelled good.
CHUNK_ROWS = ((0, 0.0, 2.3), (2048, 1.87, 2.3), (3072, 1.95, 2.33), (4096, 1.96, 2.4))


@dataclass(frozen=True)
class Bands:
    """Ratios are bytes over compressed bytes. A text of n bytes takes the row with the greatest least <= n.

    rows: (least bytes, least ratio, most ratio). The compressor knows nothing at the start of a text, so what prose
    reaches rises with length. A chunk is judged by the row of chunk_rows for its size; where they are not given, that
    is CHUNK_ROWS beside ROWS, and other rows hold for chunks too.
    """

    rows: tuple[tuple[int, float, float], ...] = ROWS
    chunk: int = 4096
    #: A text is rejected if more than this share of its chunks is outside the band.
    bad_chunks: float = 0.1
    level: int = 3
    chunk_rows: tuple[tuple[int, float, float], ...] | None = None

    def of_chunks(self) -> tuple[tuple[int, float, float], ...]:
        return self.chunk_rows or (CHUNK_ROWS if self.rows == ROWS else self.rows)


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, n_chunks long, n_bad_chunks long, base_failed boolean, kept boolean"
_FIELDS = pa.schema([(x.split()[0], {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]]) for x in SCHEMA.split(", ")])


def _per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, n).astype(np.int64)


def _again(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether an equal (row, key) came before it, and whether one comes before or after."""
    order = np.lexsort((key, row))
    same = (row[order][1:] == row[order][:-1]) & (key[order][1:] == key[order][:-1])
    before, any_ = np.zeros(len(row), bool), np.zeros(len(row), bool)
    before[order[1:]] = same  # lexsort is stable: equal items stay in text order
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    return before, any_


def word_rules(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The plain counts of each row of a batch, from its UTF-8 bytes."""
    n = len(bounds) - 1
    starts, ends, rows = word_spans(data, bounds)
    ids, _ = word_ids(data, starts, ends)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(symbol[data], out=marks[1:])
    # windows of three words of one row, equal by their words' numbers (exact within the batch)
    repeat = np.zeros(len(ids) + 3, bool)
    if len(ids) >= 3:
        inside = rows[2:] == rows[:-2]
        at = np.flatnonzero(inside)
        _, pair = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)
        _, found = _again(rows[at], pair[at] * (ids.max() + 1) + ids[at + 2])
        for k in range(3):
            repeat[at[found] + k] = True
    # lines with a word, equal by their bytes to an earlier line of the row
    newline = np.flatnonzero(data == 10)
    row_of = np.searchsorted(bounds, newline, side="right") - 1
    begin = np.concatenate([bounds[:-1], newline + 1])
    end_row = np.concatenate([np.arange(n), row_of])
    order = np.lexsort((begin, end_row))  # a row's empty last line begins where the next row does
    begin, end_row = begin[order], end_row[order]
    if n:
        stop = np.append(begin[1:], len(data) + 1) - 1
        last = np.append(end_row[1:] != end_row[:-1], True)
        stop[last] = bounds[end_row[last] + 1]
        worded = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
        begin, stop, end_row = begin[worded], stop[worded], end_row[worded]
    lines, _ = word_ids(data, begin, stop)
    again, _ = _again(end_row, lines)
    return {
        "n_words": _per_row(rows, n),
        "word_chars": _per_row(rows, n, points[ends] - points[starts]),
        "n_symbols": marks[bounds[1:]] - marks[bounds[:-1]],
        "n_dup_lines": _per_row(end_row[again], n),
        "n_repeat_words": _per_row(rows[repeat[: len(ids)]], n),
    }


def compression(data: np.ndarray, bounds: np.ndarray, bands: Bands) -> dict[str, np.ndarray]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress
    view, n = memoryview(np.ascontiguousarray(data)), len(bounds) - 1

    def outside(size: np.ndarray, ratio: np.ndarray, limits: tuple[tuple[int, float, float], ...]) -> np.ndarray:
        least, low, high = (np.array(x) for x in zip(*limits, strict=True))
        k = np.searchsorted(least, size, side="right") - 1
        return (ratio < low[k]) | (ratio > high[k])

    size = np.diff(bounds)
    whole = np.fromiter((len(squeeze(view[a:b])) if b > a else 1 for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)), np.int64, n)
    ratio = size / whole
    # fixed chunks: only texts longer than one have more to tell; a last piece under half a chunk is not judged
    pieces = [(r, a, min(a + bands.chunk, e)) for r, (b, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if e - b > bands.chunk for a in range(b, e, bands.chunk) if min(a + bands.chunk, e) - a >= bands.chunk // 2]
    row, a, b = (np.array(x, np.int64) for x in zip(*pieces, strict=True)) if pieces else (np.zeros(0, np.int64),) * 3
    bad = outside(b - a, (b - a) / np.fromiter((len(squeeze(view[i:j])) for _, i, j in pieces), np.int64, len(pieces)), bands.of_chunks())
    chunks, bad_chunks = _per_row(row, n), _per_row(row[bad], n)
    return {"ratio": ratio, "n_chunks": chunks, "n_bad_chunks": bad_chunks, "rejected": outside(size, ratio, bands.rows) | (bad_chunks > bands.bad_chunks * np.maximum(chunks, 1))}


def judge(docs: DataFrame, bands: Bands | None = None, batch_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row (SCHEMA): word counts, compression ratio, base_failed, kept.

    Null and empty texts have no words and ratio 0, and fail the base rules (under 50 words). Repeated rows are judged
    each alone; a row never meets another, so nothing is shuffled. Very long texts are batches of their own.
    """
    bands = bands or Bands()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, batch_bytes):
            data, bounds = flat_bytes(table["text"])
            out = word_rules(data, bounds) | compression(data, bounds, bands)
            n = out["n_words"]
            out["base_failed"] = (n < 50) | (100 * out["n_repeat_words"] > 50 * n)
            out["kept"] = ~out["base_failed"] & ~out.pop("rejected")
            out["doc_id"] = table["doc_id"].combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _FIELDS], schema=_FIELDS)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """The rows of docs whose text passes, with all their columns: judged in place, one row in, at most one out."""
    bands = bands or Bands()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, 4 << 20):
            data, bounds = flat_bytes(table["text"])
            base, more = word_rules(data, bounds), compression(data, bounds, bands)
            n = base["n_words"]
            kept = (n >= 50) & (100 * base["n_repeat_words"] <= 50 * n) & ~more["rejected"]
            yield from table.filter(pa.array(kept)).to_batches()

    return docs.mapInArrow(run, docs.schema)





#: Bound of the sample that bands are fitted on, and how far they reach beyond it at either end, as a share.
SAMPLE_DOCS, MARGIN = 4000, 0.06


def _ratios(docs: DataFrame, bands: Bands, batch_bytes: int) -> DataFrame:
    """(chunk, size, ratio) of each text and, of those longer than a chunk, of each chunk that is judged."""
    free = Bands(rows=((0, 0.0, float("inf")),), chunk=1 << 62, level=bands.level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, batch_bytes):
            data, bounds = flat_bytes(table.column("text"))
            cuts = [np.append(np.arange(a, b, bands.chunk), b) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if b - a > bands.chunk]
            for chunk, pieces in ((False, [bounds]), (True, cuts)):
                for edges in pieces:
                    size, ratio = np.diff(edges), compression(data[edges[0] : edges[-1]], edges - edges[0], free)["ratio"]
                    on = size >= (bands.chunk // 2 if chunk else 1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(int(on.sum()), chunk)), pa.array(size[on]), pa.array(ratio[on])], ["chunk", "size", "ratio"])

    return docs.mapInArrow(run, "chunk boolean, size long, ratio double")


def fit_bands(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, margin: float = MARGIN, bands: Bands | None = None, batch_bytes: int = 4 << 20) -> Bands:
    """Bands for documents like those labelled good: the range of their ratios in each size class of `bands`, and `margin` beyond.

    The sample is sample_docs documents labelled good at most, those of smallest id; one aggregate over it gives a
    least and greatest ratio for each class. Texts under the second class's size are judged by the most ratio alone. A
    class without a document takes the limits of the one before it (the first ones: of the one after), so longer texts than any labelled
    one are judged as the longest are. Null ids, labels and texts are left out; without a good document nothing is rejected.
    """
    bands = bands or Bands()
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy("doc_id").limit(sample_docs)
    text = id_and_text(docs).where("text != ''").join(F.broadcast(good), "doc_id", "left_semi").select("text")
    both = (bands.rows, bands.of_chunks())

    def which(rows: tuple[tuple[int, float, float], ...]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(r[0]).cast("long") for r in rows]), lambda x: x <= F.col("size"))) - 1

    classes = _ratios(text, bands, batch_bytes).withColumn("k", F.when(F.col("chunk"), which(both[1])).otherwise(which(both[0])))
    found = {(r["chunk"], r["k"]): (r["a"], r["b"]) for r in classes.groupBy("chunk", "k").agg(F.min("ratio").alias("a"), F.max("ratio").alias("b")).collect()}
    out = []
    for chunk, rows in zip((False, True), both, strict=True):
        have = [found.get((chunk, k)) for k in range(len(rows))]
        for k in range(1, len(have)):
            have[k] = have[k] or have[k - 1]
        for k in reversed(range(len(have) - 1)):
            have[k] = have[k] or have[k + 1]
        out.append(tuple((r[0], 0.0 if k == 0 or h is None else h[0] * (1 - margin), float("inf") if h is None else h[1] * (1 + margin)) for k, (r, h) in enumerate(zip(rows, have, strict=True))))
    return Bands(rows=out[0], chunk=bands.chunk, bad_chunks=bands.bad_chunks, level=bands.level, chunk_rows=out[1])
