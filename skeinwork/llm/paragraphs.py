"""Substring dedup by paragraphs: MinHash banding, exact Jaccard of what collides, removal by components.

Two kinds of paragraphs are compared, each with its own kind. A line of MIN_WORDS words or more is one: edited copies of
whole lines meet. A passage that stands within a line, or over several, has no line of its own; so every text is also cut
at content-defined places, those where the hash of the next five words is less than at the two places on either side. Of
each SPAN successive places the one of least hash begins a paragraph of MIN_WORDS words. These overlap lines and each other
as they come, but begin three words apart at least, so that no two of a text are alike for their overlap. A passage of 51
words (MIN_WORDS + SPAN - 1 and two on either side) holds a whole one, cut alike in every text that has the passage. All that lie
in a repeated passage go; up to REACH words at its ends, where none is whole, can stay.

Lines are banded. Passages have as many words as each other, so two of 20 words that are LEAST alike differ by one shingle
on either side at most; and if either repeats none of its three-word runs, its shingles follow each other in one way only, so
that the other holds all of its words but the first or but the last, in their order. Such pairs meet by a hash of 19 words,
without bands and with none lost (see _runs_decide). Only passages that do repeat a three-word run are banded too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes, flat_bytes, hot_join, id_and_text, mix64, release, word_hashes, word_ids, word_spans, write_table
from .links import classes, shared_rows
from .near_dup import _lists, _rows
from .signatures import band_keys

LEAST = 0.8
MIN_WORDS = 20
SPAN = 28
REACH = SPAN + 3  # in passages of which no paragraph is lost, the words at either end that none covers
WIDTH = 5  # words of a shingle
#: Bands and places in each, tuned for recall: at similarity 0.8 two lines share a band with probability 0.995, two
#: passages that both repeat a three-word run with 0.943 (0.990 at 0.88). Other passages need none.
LINE_BANDS, PASSAGE_BANDS = (10, 4), (4, 3)

_KEY = "struct<doc_id:long,place:long>"
_KEY_TYPE = pa.struct([("doc_id", pa.int64()), ("place", pa.int64())])
_MARKED = pa.schema([("id", _KEY_TYPE), ("start", pa.int32()), ("end", pa.int32()), ("hashes", pa.list_(pa.int64()))])
_CONTENT = pa.schema([("id", _KEY_TYPE), ("elements", pa.list_(pa.int64()))])


def text_key(text: Column) -> Column:
    """31 bits of a text's hash, which tell apart texts that share an id; a null text is empty."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 33)


class _Words:
    """A batch's words: byte starts and ends, row, hash, and the hash of the five words from each on (where has_five)."""

    def __init__(self, table: pa.Table) -> None:
        self.data, self.bounds = flat_bytes(table["text"])
        self.n = table.num_rows
        self.starts, self.ends, self.rows = word_spans(self.data, self.bounds)
        ids, distinct = word_ids(self.data, self.starts, self.ends)
        self.hash = word_hashes(distinct)[ids] if len(ids) else np.zeros(0, np.uint64)
        size = len(self.hash)
        five = np.zeros(size, np.uint64)
        for k in range(WIDTH):
            five[: max(size - k, 0)] = five[: max(size - k, 0)] * np.uint64(0x9E3779B97F4A7C15) + self.hash[k:]
        self.five = mix64(five)
        self.per_row = np.bincount(self.rows, minlength=self.n)
        self.first = np.cumsum(self.per_row) - self.per_row
        self.text = table["key"].to_numpy()

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 word of each line with a word."""
        if not len(self.starts):
            return (np.zeros(0, np.int64),) * 2
        breaks = np.cumsum(self.data == 10)[self.starts]
        edge = np.flatnonzero(np.append(True, (breaks[1:] != breaks[:-1]) | (self.rows[1:] != self.rows[:-1])))
        return edge, np.append(edge[1:], len(self.starts))

    def passages(self, size: int, span: int) -> np.ndarray:
        """First word of each paragraph of `size` words that begins at a content-defined place."""
        places = self.per_row - size + 1  # of a row, where one can begin
        total = len(self.five)
        if not total or places.max() < 1:
            return np.zeros(0, np.int64)
        bits = np.uint64(max(24, int(total).bit_length()))
        mask = (np.uint64(1) << bits) - np.uint64(1)
        key = (self.five & ~mask) | np.arange(total, dtype=np.uint64)
        own = np.arange(total) - self.first[self.rows]
        key[own >= places[self.rows]] = np.iinfo(np.uint64).max
        lower = np.zeros(total, bool)
        for k in (1, 2):
            if total > k:
                near = self.rows[k:] == self.rows[:-k]
                lower[k:] |= near & (key[:-k] < key[k:])
                lower[:-k] |= near & (key[k:] < key[:-k])
        key[lower] = np.iinfo(np.uint64).max
        found = []
        few = np.flatnonzero((places > 0) & (places <= span))
        if len(few):
            edges = np.stack([self.first[few], self.first[few] + places[few]], axis=1).reshape(-1)
            found.append(np.minimum.reduceat(np.append(key, key[-1]), edges)[::2])
        if (places > span).any():
            least, width = key, 1
            while 2 * width <= span:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            n = total - span + 1
            least = np.minimum(least[:n], least[span - width : span - width + n])
            found.append(least[(own <= places[self.rows] - span)[:n]])
        found = np.unique(np.concatenate(found))
        return np.sort(found[found < np.iinfo(np.uint64).max] & mask).astype(np.int64)


def _signatures(words: _Words, first: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """(paragraphs, size) MinHash values of the five-word shingles that begin in [first, end - 4)."""
    out = np.zeros((len(first), size), np.uint64)
    if len(first):
        edges = np.stack([first, end - WIDTH + 1], axis=1).reshape(-1)
        for k in range(size):
            hashed = np.append(words.five * (mix64(np.array([k + 1], np.uint64)) | np.uint64(1)), np.uint64(0))
            out[:, k] = np.minimum.reduceat(hashed, edges)[::2]
    return out


def _runs_decide(size: int, least: float) -> bool:
    """Whether two passages of `size` words that are `least` alike have size - 1 words running in common, unless both repeat
    a run of WIDTH - 2 words.

    Let A, of n shingles, repeat none, so that its shingles are n different ones and B, that has c of them and u others,
    has c >= least * (n + u). As c + u <= n, u is at most n * (1 - least) / (1 + least); let that be less than 2. Within B a
    shingle of A can be followed by the next of A or by the other one, e. What e leads back to would have to begin with
    the WIDTH - 2 words that end the shingle before e: in A these stand in one place, where e would be A's own shingle. So
    B's shingles of A are one run, with e at one end (at both, A would repeat what e begins and ends with), or B is A.
    """
    return (size - WIDTH + 1) * (1 - least) / (1 + least) < 2


def _runs(hashes: np.ndarray) -> np.ndarray:
    """(rows, 2): 64-bit hashes of each row's words but the last and but the first; one function of the words for both."""
    out = np.zeros((len(hashes), 2), np.uint64)
    for side in (0, 1):
        for k in range(side, hashes.shape[1] - 1 + side):
            out[:, side] = mix64(out[:, side] * np.uint64(0x9E3779B97F4A7C15) + hashes[:, k])
    return out


def _repeats(hashes: np.ndarray) -> np.ndarray:
    """Which rows of word hashes hold a run of WIDTH - 2 words twice."""
    n = hashes.shape[1] - WIDTH + 3
    run = np.zeros((len(hashes), max(n, 0)), np.uint64)
    for k in range(WIDTH - 2):
        run = run * np.uint64(0x9E3779B97F4A7C15) + hashes[:, k : k + n]
    run = np.sort(run, axis=1)
    return (run[:, 1:] == run[:, :-1]).any(axis=1)


def _ids(table: pa.Table, words: _Words, first: np.ndarray, kind: int) -> pa.StructArray:
    """doc_id, and place: 31 bits of the text's hash, 31 of the paragraph's first word, and its kind (1: within lines)."""
    row = words.rows[first]
    place = words.text[row] << 32 | (first - words.first[row]) << 1 | kind
    return pa.StructArray.from_arrays([table["doc_id"].combine_chunks().take(pa.array(row)), pa.array(place)], fields=list(_KEY_TYPE))


def marked_paragraphs(docs: DataFrame, least: float = LEAST, min_words: int = MIN_WORDS, span: int = SPAN, line_bands: tuple[int, int] = LINE_BANDS, passage_bands: tuple[int, int] = PASSAGE_BANDS) -> DataFrame:
    """(id, start, end, hashes) of each paragraph of documents (doc_id, text, key): its place in code points, and its hashes.

    The first two hashes are its print, 128 bits: equal for equal words. They are followed by its band keys, if it has any.
    A passage's print is that of its words but the last and but the first, and both are keys as well.
    """
    decided = _runs_decide(min_words, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, 2 << 20):
            words = _Words(table)
            points = np.append(0, np.cumsum((words.data & 0xC0) != 0x80))
            first, end = words.lines()
            long = end - first >= min_words
            first, end = first[long], end[long]
            prints = b"".join(xxhash.xxh3_128_digest(words.hash[x:y].tobytes()) for x, y in zip(first.tolist(), end.tolist(), strict=True))
            lines = np.hstack([np.frombuffer(prints, np.int64).reshape(-1, 2), band_keys(_signatures(words, first, end, line_bands[0] * line_bands[1]), line_bands[0])])
            inner = words.passages(min_words, span)
            hashes = words.hash[inner[:, None] + np.arange(min_words)]
            runs = _runs(hashes).view(np.int64)
            banded = _repeats(hashes) if decided else np.ones(len(inner), bool)
            some = inner[banded]
            bands = band_keys(_signatures(words, some, some + min_words, passage_bands[0] * passage_bands[1]), passage_bands[0]) ^ 1
            plain = inner[~banded]
            for kind, x, y, own in ((0, first, end, lines), (1, plain, plain + min_words, runs[~banded]), (1, some, some + min_words, np.hstack([runs[banded], bands]))):
                base = points[words.bounds[words.rows[x]]]
                yield pa.RecordBatch.from_arrays([_ids(table, words, x, kind), pa.array(points[words.starts[x]] - base, pa.int32()), pa.array(points[words.ends[y - 1]] - base, pa.int32()), _rows(own, pa.int64())], schema=_MARKED)

    return docs.mapInArrow(run, f"id {_KEY}, start int, end int, hashes array<long>")


def paragraph_content(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, elements): of documents (doc_id, text, key, places), the shingle sets of the paragraphs at these places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, 2 << 20):
            words = _Words(table)
            lists = table["places"].combine_chunks()
            place = lists.flatten().to_numpy()
            row = np.repeat(np.arange(words.n), lists.value_lengths().to_numpy())
            own = place >> 32 == words.text[row]  # else it is of another text of this id
            place, row = place[own], row[own]
            a = (place >> 1 & 0x7FFFFFFF) + words.first[row]
            first, end = words.lines()
            b = np.where(place & 1 == 1, a + min_words, end[np.searchsorted(first, a, side="right") - 1] if len(first) else a)
            n = b - a - WIDTH + 1
            bounds = np.append(0, np.cumsum(n))
            owner = np.repeat(np.arange(len(a)), n)
            element = words.five[np.repeat(a, n) + np.arange(len(owner)) - bounds[owner]]
            order = np.lexsort((element, owner))
            element, owner = element[order], owner[order]
            new = np.append(True, (element[1:] != element[:-1]) | (owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, bool)
            ids = pa.StructArray.from_arrays([table["doc_id"].combine_chunks().take(pa.array(row)), pa.array(place)], fields=list(_KEY_TYPE))
            yield pa.RecordBatch.from_arrays([ids, _lists(element[new].view(np.int64), np.searchsorted(owner[new], np.arange(len(a) + 1)), pa.int64())], schema=_CONTENT)

    return docs.mapInArrow(run, f"id {_KEY}, elements array<long>")


def repeated_paragraphs(docs: DataFrame, least: float = LEAST, min_words: int = MIN_WORDS, span: int = SPAN, line_bands: tuple[int, int] = LINE_BANDS, passage_bands: tuple[int, int] = PASSAGE_BANDS, sketches: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, start, end, source_id) of each paragraph to remove; start and end are code points, end exclusive.

    Two paragraphs (see above) of one kind are linked if the sets of their five-word shingles have a Jaccard similarity
    of `least` or more. Of each component the first (smallest doc_id, then place) stays; source_id is its document. Null
    or empty texts and rows with a null id have none. Rows that share id and text are one document; of rows that share
    an id but not the text each is a document, and `text` (see text_key) tells them apart. A passage repeated within a
    document is removed there too. An empty table gives no rows.
    """
    base = id_and_text(docs, id_col, text_col).where("doc_id is not null").withColumn("key", text_key(F.col("text")))
    marked = write_table(marked_paragraphs(base, least, min_words, span, line_bands, passage_bands), "paragraphs")
    # a paragraph none of whose keys another has is alike to none; equal ones share all of theirs
    kind = F.col("id.place").bitwiseAND(1)
    keys = F.when(kind == 1, F.col("hashes")).otherwise(F.expr("slice(hashes, 3, size(hashes))"))
    each = marked.select("id", "start", "end", F.struct(F.col("hashes")[0].alias("x"), F.col("hashes")[1].alias("y")).alias("print"), F.explode(keys).alias("key"))
    met = shared_rows(marked.select(F.explode(keys).alias("key")), each.where(kind == 0), each.where(kind == 1))
    release(marked)
    # of paragraphs with the same words the first stands for all
    all_met = reduce(DataFrame.unionByName, met)
    same = write_table(all_met.groupBy("print").agg(F.min("id").alias("rep"), F.max("id").alias("last"), F.count("*").alias("n")).where("rep != last").drop("last"), "same-paragraphs")
    named = write_table(hot_join(all_met, same, "print", "left").select("key", "id", "start", "end", F.coalesce("rep", "id").alias("rep")), "named-paragraphs")
    release(*met, same)
    known = write_table(named.select("id", "start", "end", "rep").distinct(), "known-paragraphs")
    firsts = write_table(named.where("id = rep").groupBy("id").agg(F.collect_set("key").alias("keys")), "first-paragraphs")
    release(named)

    def of(ids: DataFrame) -> DataFrame:
        wanted = ids.groupBy(F.col("id.doc_id").alias("of")).agg(F.collect_list("id.place").alias("places"))
        mine = base.join(wanted.hint("merge"), base.doc_id == F.col("of")).select("doc_id", "text", "key", "places")
        return paragraph_content(mine, min_words).distinct()

    labels, content = classes(firsts, of, least, sketches)
    release(content, firsts)
    sizes = known.groupBy("rep").agg(F.count("*").alias("n"))
    out = hot_join(known.select("id", "start", "end", "rep"), labels.withColumnRenamed("id", "rep"), "rep", "left", sizes=sizes).withColumn("label", F.coalesce("label", "rep"))
    gone = out.where("id != label").select("id.doc_id", F.shiftright("id.place", 32).alias("text"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("label.doc_id").alias("source_id"))
    gone = write_table(gone, "removed-paragraphs")
    release(known)
    return gone


def _spans(removed: DataFrame) -> DataFrame:
    """(of, of_text, spans, source_ids) of each document: its removed spans, in order, joined where only one character parts them."""
    lists = removed.groupBy(F.col("doc_id").alias("of"), F.col("text").alias("of_text")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("at"), F.array_sort(F.collect_set("source_id")).alias("source_ids"))
    none = "cast(array() as array<struct<start:bigint,end:bigint>>)"
    fold = f"aggregate(at, named_struct('done', {none}, 's', -1L, 'e', -1L), (a, x) -> case when a.e < 0 then named_struct('done', a.done, 's', x.start, 'e', x.end) when x.start <= a.e + 1 then named_struct('done', a.done, 's', a.s, 'e', greatest(a.e, x.end)) else named_struct('done', concat(a.done, array(named_struct('start', a.s, 'end', a.e))), 's', x.start, 'e', x.end) end, a -> concat(a.done, array(named_struct('start', a.s, 'end', a.e))))"
    return lists.select("of", "of_text", F.expr(fold).alias("spans"), "source_ids")


def without_paragraphs(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the removed spans taken out of their texts; all other columns, rows and null texts stay as they are."""
    out = [f"c{k}" for k in range(len(docs.columns))]  # so that no column of docs can clash
    rows = docs.select(*[docs[c].alias(x) for c, x in zip(docs.columns, out, strict=True)])
    id_, text = out[docs.columns.index(id_col)], out[docs.columns.index(text_col)]
    joined = rows.withColumn("key", text_key(F.col(text))).join(_spans(removed).hint("merge"), (F.col(id_).cast("long") == F.col("of")) & (F.col("key") == F.col("of_text")), "left")
    kept = f"array_join(zip_with(spans, concat(array(0L), transform(spans, s -> s.end)), (s, b) -> if(s is null, substring({text}, cast(b + 1 as int)), substring({text}, cast(b + 1 as int), cast(s.start - b as int)))), '')"
    cut = F.when(F.col("spans").isNull(), F.col(text)).otherwise(F.expr(kept))
    return joined.select(*[(cut if x == text else F.col(x)).alias(c) for c, x in zip(docs.columns, out, strict=True)])


def summary(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_removed (spans), removed_chars, spans ("start:end" in order, comma-joined), source_ids (sorted).

    A row without an id, without a text or with nothing repeated has 0, 0, "" and none.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_key(docs[text_col]).alias("key"))
    joined = rows.join(_spans(removed).hint("merge"), (F.col("doc_id") == F.col("of")) & (F.col("key") == F.col("of_text")), "left")
    spelled = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    chars = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", F.coalesce(F.size("spans").cast("long"), zero).alias("n_removed"), F.coalesce(chars, zero).alias("removed_chars"), F.coalesce(spelled, F.lit("")).alias("spans"), F.coalesce("source_ids", F.array().cast("array<long>")).alias("source_ids"))
