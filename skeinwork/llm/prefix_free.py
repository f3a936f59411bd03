"""Suffix-array dedup by prefix-free parsing: removal of bytes covered by 100-byte strings that start earlier too.

1. Parse. Triggers chosen by a rolling hash cut every text into phrases that overlap by length - 1 bytes, so each
   100-byte string lies in exactly one phrase, and copies of a passage are cut alike wherever they stand.
2. Parse order. Phrases are grouped by content; a group's first occurrence is the dictionary's, and every start in
   a later one is a repeat. This settles copies of whole phrases, the bulk of repetitive text, without looking inside.
3. Dictionary order. Only dictionary phrases that share a trigger with another can hold a string in common. Each
   trigger's phrases get a suffix array in byte order (suffixes cut to 100 bytes); equal neighbours are the strings
   that several phrases hold, and with the phrases' first places they give each string's first place in the corpus.
The parse beyond a phrase is never consulted, for the overlap already holds all that a 100-byte suffix can reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes, flat_bytes, hot_join, id_and_text, mix64, release, write_table

LENGTH = 100  # bytes of a repeated string
GRAM = 24  # bytes of a trigger
SEGMENT = 4 << 20  # starts that are parsed at once; a longer document is parsed in segments


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Rolling hashes of all `size`-byte strings, by doubling (size = a sum of powers of two); mixed."""
    base = 0x9E3779B97F4A7C15
    whole, done, width, part = None, 0, 1, data.astype(np.uint64) + np.uint64(1)
    n = len(data) - size + 1
    while done < size:
        if size & width:
            piece = part[done : done + n]
            whole = piece.copy() if whole is None else whole * np.uint64(pow(base, width, 1 << 64)) + piece
            done += width
        if done < size:
            part = part[:-width] * np.uint64(pow(base, width, 1 << 64)) + part[width:]
            width *= 2
    return mix64(whole)


def parse(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, count, trigger): phrases of the rows of a buffer (of at most 8 MB).

    The trigger of a `length`-byte string is its `gram`-byte string of least rolling hash, the leftmost of several; a
    phrase is all strings that start at `count` successive places, from `first` on, and share one trigger's place. So
    equal strings have triggers that are equal and lie alike, and every string lies in one phrase.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    hashes = _gram_hashes(data, gram)
    place = np.uint64((1 << 23) - 1)
    key = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)  # the place decides between equal hashes
    width, window = 1, length - gram + 1
    least = key
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[window - width : window - width + n])
    at = (least & place).astype(np.int64)
    crosses = np.zeros(n + length, bool)  # starts whose string would leave their row
    for end in np.unique(bounds[1:-1]).tolist():
        crosses[max(0, end - length + 1) : end] = True
    valid = np.flatnonzero(~crosses[:n])
    if not len(valid):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    own = at[valid]
    new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (valid[1:] != valid[:-1] + 1)))
    return valid[new], np.diff(np.append(new, len(valid))), hashes[own[new]]


_PHRASES = "trigger long, print long, doc_id long, start long, n int"
_PHRASES_TYPE = pa.schema([("trigger", pa.int64()), ("print", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])
_RUNS = "doc_id long, start long, n int"
_RUNS_TYPE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])


def phrases(docs: DataFrame, length: int = LENGTH, segment: int = SEGMENT) -> DataFrame:
    """(trigger, print, doc_id, start, n) of every phrase; print hashes its length - 1 + n bytes."""

    def rows(data: np.ndarray, bounds: np.ndarray, ids: pa.Array, shift: int) -> pa.RecordBatch:
        first, count, trigger = parse(data, bounds, length)
        view = memoryview(np.ascontiguousarray(data))
        digest = xxhash.xxh3_64_intdigest
        prints = np.fromiter((digest(view[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)), np.uint64, len(first))
        row = np.searchsorted(bounds, first, side="right") - 1
        return pa.RecordBatch.from_arrays([pa.array(trigger.view(np.int64)), pa.array(prints.view(np.int64)), ids.take(pa.array(row)), pa.array(first - bounds[row] + shift), pa.array(count, pa.int32())], schema=_PHRASES_TYPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, segment // 2):
            data, bounds = flat_bytes(table["text"])
            ids = table["doc_id"].combine_chunks()
            if len(data) <= segment + length:
                yield rows(data, bounds, ids, 0)
                continue
            for k in range(table.num_rows):  # a row longer than a segment: its segments overlap by length - 1
                for a in range(bounds[k], max(bounds[k + 1] - length + 1, bounds[k] + 1), segment):
                    part = data[a : min(a + segment + length - 1, bounds[k + 1])]
                    yield rows(part, np.array([0, len(part)]), ids.slice(k, 1), int(a - bounds[k]))

    return docs.mapInArrow(run, _PHRASES)


def _suffixes(texts: list[bytes], n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of phrases' bytes: all bytes, and for each of their `length`-byte suffix heads its phrase, offset and place."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(n + length - 1) - (n + length - 1)
    which = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return data, which, offset, begin[which] + offset


def later_strings(texts: list[bytes], trigger: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of the strings of dictionary phrases that an earlier place holds too. Phrases of one trigger come together.

    Each trigger's phrases get a suffix array: their suffixes' first `length` bytes in byte order, equal ones by place.
    A suffix equal to its neighbour before is a string that starts earlier too.
    """
    data, which, offset, at = _suffixes(texts, n, length)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    d, s, group = doc[which], start[which] + offset, trigger[which]
    by_place = np.lexsort((s, d, group))
    heads = np.lib.stride_tricks.sliding_window_view(data, length)
    edges = np.append(np.flatnonzero(np.append(True, group[by_place][1:] != group[by_place][:-1])), len(by_place))
    later = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = by_place[a:b]
        head = np.ascontiguousarray(heads[at[own]]).view(f"S{length}").ravel()
        array = np.argsort(head, kind="stable")
        rows = heads[at[own[array]]]
        later.append(own[array[1:][(rows[1:] == rows[:-1]).all(axis=1)]])
    found = np.concatenate(later)
    return d[found], s[found]


def _as_runs(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1))) if len(doc) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(doc)) - 1 if len(doc) else new
    return pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(start[new]), pa.array(start[last] - start[new] + 1, pa.int32())], schema=_RUNS_TYPE)


def _cut_out(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted (trigger, doc_id, start, n), each with its bytes: (trigger, doc_id, start, n, text binary)."""
    lists = wanted.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("start", "n", "trigger")).alias("wanted"))
    joined = docs.join(lists, F.col("doc_id") == F.col("of")).select("doc_id", "text", "wanted")
    kind = pa.schema([("trigger", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, 2 << 20):
            data, bounds = flat_bytes(table["text"])
            view = data.tobytes()
            lists = table["wanted"].combine_chunks()
            flat = lists.flatten()
            row = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy())
            start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
            a = bounds[row] + start
            texts = [view[x:y] for x, y in zip(a.tolist(), (a + n + length - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([flat.field("trigger"), table["doc_id"].combine_chunks().take(pa.array(row)), pa.array(start), pa.array(n, pa.int32()), pa.array(texts, pa.binary())], schema=kind)

    return joined.mapInArrow(run, "trigger long, doc_id long, start long, n int, text binary")


def _small_groups(cut: DataFrame, length: int, chunk: int) -> DataFrame:
    """Runs of later strings where whole trigger groups fit a chunk: sorted by trigger, dealt in whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(batch: pa.Table) -> pa.RecordBatch:
            d, s = later_strings(batch["text"].to_pylist(), batch["trigger"].to_numpy(), batch["doc_id"].to_numpy(), batch["start"].to_numpy(), batch["n"].to_numpy().astype(np.int64), length)
            return _as_runs(d, s)

        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= chunk:
                table = pa.Table.from_batches(held)
                trigger = table["trigger"].to_numpy()
                edge = int(np.searchsorted(trigger, trigger[-1]))  # the last group may go on
                if edge:
                    yield out(table.slice(0, edge))
                    held, rows = table.slice(edge).to_batches(), table.num_rows - edge
        if held:
            yield out(pa.Table.from_batches(held))

    return cut.repartition("trigger").sortWithinPartitions("trigger").mapInArrow(run, _RUNS)


def _large_groups(cut: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size: a row for each string, its bytes as the key of an aggregate that combines early."""
    kind = pa.schema([("trigger", pa.int64()), ("x", pa.binary()), ("doc_id", pa.int64()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy().astype(np.int64)
            for k in range(0, len(n), 4096):
                part = batch.slice(k, 4096)
                texts = part.column("text").to_pylist()
                _, which, offset, _ = _suffixes(texts, n[k : k + 4096], length)
                x = [texts[w][o : o + length] for w, o in zip(which.tolist(), offset.tolist(), strict=True)]
                index = pa.array(which)
                yield pa.RecordBatch.from_arrays([part.column("trigger").take(index), pa.array(x, pa.binary()), part.column("doc_id").take(index), pa.array(part.column("start").to_numpy()[which] + offset)], schema=kind)

    strings = write_table(cut.mapInArrow(run, "trigger long, x binary, doc_id long, start long"), "strings")
    first = strings.groupBy("trigger", "x").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("times")).where("times > 1").select("trigger", "x", "first")
    return strings.join(first, ["trigger", "x"]).where("doc_id != first.doc_id or start != first.start").select("doc_id", "start", F.lit(1).alias("n"))


def repeated_runs(base: DataFrame, length: int = LENGTH, segment: int = SEGMENT, large: int = 20_000) -> DataFrame:
    """(doc_id, start, n): runs of n starts of strings that also start earlier, of documents (doc_id, text)."""
    parsed = write_table(phrases(base, length, segment), "phrases")
    shared = parsed.groupBy("trigger").agg(F.count("*").alias("times"), (F.min("print") != F.max("print")).alias("several")).where("times > 1")
    shared = write_table(shared, "shared-triggers")
    again = write_table(hot_join(parsed, shared, "trigger", n="times").drop("times"), "shared-phrases")
    release(parsed, shared)
    dictionary = write_table(again.groupBy("trigger", "print").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.first("n").alias("n"), F.first("several").alias("several"), F.count("*").alias("times")), "dictionary")
    phrase = F.struct("trigger", "print").alias("phrase")
    known = dictionary.where("times > 1").select(phrase, "first", "times")
    copies = hot_join(again.select(phrase, "doc_id", "start", "n"), known, "phrase", n="times")
    copies = write_table(copies.where("doc_id != first.doc_id or start != first.start").select("doc_id", "start", "n"), "copied-phrases")
    release(again)
    several = dictionary.where("several").select("trigger", F.col("first.doc_id").alias("doc_id"), F.col("first.start").alias("start"), "n")
    cut = write_table(_cut_out(base, several, length), "dictionary-texts")
    sizes = cut.groupBy("trigger").agg(F.count("*").alias("size")).where(F.col("size") > large).select("trigger")
    sizes = write_table(sizes, "large-triggers")
    if sizes.isEmpty():
        inside = _small_groups(cut, length, large)
    else:
        inside = _small_groups(cut.join(sizes, "trigger", "left_anti"), length, large).unionByName(_large_groups(cut.join(sizes, "trigger", "left_semi"), length))
    inside = write_table(inside, "dictionary-runs")
    release(dictionary, cut, sizes)
    return copies.unionByName(inside)


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_OUT_TYPE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    cover = np.zeros(size + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, ends, -1)
    return np.cumsum(cover[:-1]) > 0


def _numbered(base: DataFrame) -> DataFrame:
    """(doc_id, mark, number, rows) of the distinct documents of rows that repeat ids: numbers go by id, then by the text's hash."""
    found = base.where("doc_id is not null").groupBy("doc_id", F.xxhash64("text").alias("mark")).agg(F.count("*").alias("rows"))
    return write_table(found.orderBy("doc_id", "mark").withColumn("number", F.monotonically_increasing_id()), "documents")


def _with_runs(base: DataFrame, length: int, segment: int, large: int) -> DataFrame:
    """(doc_id, text, runs) of every row. Ids that come once are documents; otherwise documents are numbered first."""
    no_id = base.where("doc_id is null").withColumn("runs", F.lit(None).cast("array<struct<start:bigint,n:int>>"))
    rows = base.where("doc_id is not null")
    listed = lambda runs: runs.groupBy(F.col("doc_id").alias("number")).agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    if rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        lists = listed(repeated_runs(rows, length, segment, large))
        return rows.join(lists, F.col("doc_id") == F.col("number"), "left").select("doc_id", "text", "runs").unionByName(no_id)
    numbers = _numbered(rows).withColumn("key", F.struct("doc_id", "mark")).select("key", "number", "rows")
    marked = rows.withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("mark")))
    texts = marked.groupBy("key").agg(F.first("text").alias("text")).join(numbers, "key").select(F.col("number").alias("doc_id"), "text")
    lists = listed(repeated_runs(write_table(texts, "document-texts"), length, segment, large))
    small = numbers.join(lists, "number", "left").select("key", "rows", "runs")
    return hot_join(marked, small, "key", n="rows").select("doc_id", "text", "runs").unionByName(no_id)


def removed_bytes(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", segment: int = SEGMENT, large: int = 20_000) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that stay).

    Texts are UTF-8 bytes. A byte goes if a `length`-byte string over it also starts earlier: in a document of smaller
    doc_id, or before in the same one; overlaps count, and all is judged on the input. Null and empty texts, and texts
    under `length` bytes, keep everything. Rows with a null id are left as they are and no earlier place for others.
    Rows that repeat an id and its text are one document and get the same result. Other texts under one id are documents
    of their own, which follow one another in the order of their texts' hashes. Trigger groups of more than `large` dictionary phrases go by rows instead of in one task; the result is the same.
    """
    base = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, 2 << 20):
            data, bounds = flat_bytes(table["text"])
            lists = table["runs"].combine_chunks()
            out = []
            for k, doc_id in enumerate(table["doc_id"].to_pylist()):
                own = data[bounds[k] : bounds[k + 1]]
                at = lists[k].values
                if at is None or not len(at):
                    out.append((doc_id, len(own), 0, 0, hashlib.sha256(own).hexdigest()))
                    continue
                start, n = at.field("start").to_numpy(), at.field("n").to_numpy()
                gone = _covered(len(own), start, start + n + length - 1)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((doc_id, len(own), int(gone.sum()), spans, hashlib.sha256(own[~gone]).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT_TYPE, strict=True)], schema=_OUT_TYPE)

    return _with_runs(base, length, segment, large).mapInArrow(run, _OUT)
