"""Packing: vector bin packing by dot products, under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes
from .tokens import word_bpe_ids

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, n_loss long"
_FIELDS = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])


@dataclass(frozen=True)
class Limits:
    """Of a sequence. A remaining space of at least `cut` tokens that no whole example fits is filled by cutting one."""

    tokens: int = 4096
    segments: int = 64
    loss: int = 4096
    cut: int = 16


class Pool:
    """Examples waiting in a task: pieces (example, start, end), and how many of their tokens bear loss."""

    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.who, self.start, self.end, self.free = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, who: np.ndarray, size: np.ndarray, free: np.ndarray) -> None:
        """free: tokens at an example's beginning that bear no loss (a prompt)."""
        for k, x in (("who", who), ("start", np.zeros(len(who), np.int64)), ("end", size), ("free", free)):
            setattr(self, k, np.concatenate([getattr(self, k), x]))

    @property
    def tokens(self) -> int:
        return int((self.end - self.start).sum())

    def _loss(self, i=slice(None)) -> np.ndarray:
        return np.maximum(0, self.end[i] - np.maximum(self.start[i], self.free[i]))

    def fill(self, leave: int) -> Iterator[list[tuple[int, int, int]]]:
        """Sequences (lists of (example, start, end)) until at most `leave` tokens wait; with leave 0, all of them.

        The open sequence takes, of the pieces that fit what is left of every limit, the one whose vector of sizes has
        the largest dot product with what is left (all in parts of the limits). If none fits and `cut` tokens or more
        are left, it takes the beginning of the piece of the largest product, cut to what is left. Pieces of the same
        sizes are alike, so kinds of sizes are looked at, of which T waiting tokens can make few, and not pieces; of a
        kind the one that waits longest is taken.
        """
        most = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        (size, loss), kind = np.unique(np.stack([self.end - self.start, self._loss()]), axis=1, return_inverse=True)
        order = np.argsort(kind, kind="stable")
        waiting = [deque(x.tolist()) for x in np.split(order, np.cumsum(np.bincount(kind, minlength=len(size)))[:-1])] if len(size) else []
        known = {(a, b): k for k, (a, b) in enumerate(zip(size.tolist(), loss.tolist(), strict=True))}
        size, loss = size.astype(float), loss.astype(float)
        alive = size > 0
        total = self.tokens
        while total > leave:
            left, out = most.copy(), []
            while left[1] >= 1 and left[0] >= 1 and total:
                product = np.where(alive, size * (left[0] / most[0] ** 2) + loss * (left[2] / most[2] ** 2), -1.0)
                fits = alive & (size <= left[0]) & (loss <= left[2])
                if fits.any():
                    k = int(np.argmax(np.where(fits, product, -1.0)))
                    i, take = waiting[k][0], int(size[k])
                else:
                    if left[0] < self.limits.cut and out:
                        break
                    k = int(np.argmax(product))
                    i = waiting[k][0]
                    # the longest beginning within both limits: `free` tokens at most come without loss
                    take = int(min(size[k], left[0], left[2] + max(0, int(self.free[i]) - int(self.start[i]))))
                    if take < 1:
                        break
                begin = int(self.start[i])
                out.append((int(self.who[i]), begin, begin + take))
                left -= (take, 1, max(0, begin + take - max(begin, int(self.free[i]))))
                total -= take
                waiting[k].popleft()
                alive[k] = bool(waiting[k])
                self.start[i] += take
                if self.start[i] < self.end[i]:
                    rest = (int(self.end[i] - self.start[i]), int(self._loss(i)))
                    if rest not in known:
                        known[rest] = len(waiting)
                        waiting.append(deque())
                        size, loss, alive = np.append(size, rest[0]), np.append(loss, rest[1]), np.append(alive, True)
                    waiting[known[rest]].append(i)
                    alive[known[rest]] = True
            yield out
        held = self.end > self.start
        for k in ("who", "start", "end", "free"):
            setattr(self, k, getattr(self, k)[held])


def without_padding(sequences: Iterator[list[tuple[int, int, int]]], limits: Limits) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences that a limit other than tokens has closed, or that are the last, as parts of power-of-two lengths, which
    need no padding; those that are full but for less than `cut` tokens stay whole."""
    for sequence in sequences:
        if limits.tokens - sum(b - a for _, a, b in sequence) < limits.cut:
            yield sequence
        else:
            yield from power_of_two_parts(sequence, limits.tokens)


def power_of_two_parts(sequence: list[tuple[int, int, int]], tokens: int) -> Iterator[list[tuple[int, int, int]]]:
    """A partly filled sequence as sequences of power-of-two lengths."""
    sequence = list(sequence)
    left = sum(b - a for _, a, b in sequence)
    while left:
        room = size = tokens if left >= tokens else 1 << (left.bit_length() - 1)
        out = []
        while room:
            who, a, b = sequence.pop(0)
            take = min(room, b - a)
            out.append((who, a, a + take))
            if take < b - a:
                sequence.insert(0, (who, a + take, b))
            room -= take
        left -= size
        yield out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, limits: Limits | None = None, id_col: str = "doc_id", text_col: str = "text", free_col: str | None = None, batch_bytes: int = 4 << 20) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_loss.

    An example is a text's ids and end_id (a null or empty text: end_id alone); free_col says how many ids at its
    beginning bear no loss (a prompt; 1 if not given, for nothing predicts the first id). Each task packs what it reads:
    a pool of one batch and what an earlier one left, so memory is bounded and nothing is shuffled. Sequences that
    the limits on segments or loss close early, and the last one, are cut to powers of two. sequence_id is unique over tasks. Repeated rows and null ids are packed as they come; an
    example longer than a sequence, however long, is cut.
    """
    limits = limits or Limits()
    free = F.lit(1) if free_col is None else F.greatest(F.coalesce(docs[free_col].cast("long"), F.lit(1)), F.lit(1))
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), free.cast("long").alias("free"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        pool, ids, names, counter = Pool(limits), {}, {}, 0

        def rows(sequences) -> pa.RecordBatch:
            nonlocal number
            out = {f.name: [] for f in _FIELDS}
            for sequence in sequences:
                offset = 0
                for who, a, b in sequence:
                    own, skip = ids[who]
                    values = (names[who], a, b - a, zlib.crc32(own[a:b].astype("<u4")), len(own), number, offset, max(0, b - max(a, skip)))
                    for f, v in zip(_FIELDS, values, strict=True):
                        out[f.name].append(v)
                    offset += b - a
                number += 1
            return pa.RecordBatch.from_pydict(out, schema=_FIELDS)

        for table in batches_by_bytes(batches, batch_bytes):
            flat, bounds = word_bpe_ids(table["text"], tokenizer_path)
            n, skip = table.num_rows, table["free"].to_numpy()
            for k, doc_id in enumerate(table["doc_id"].to_pylist()):
                ids[counter + k] = (np.append(flat[bounds[k] : bounds[k + 1]], np.uint16(end_id)), int(skip[k]))
                names[counter + k] = doc_id
            pool.add(np.arange(counter, counter + n), np.diff(bounds) + 1, skip.astype(np.int64))
            counter += n
            yield rows(without_padding(pool.fill(32 * limits.tokens), limits))
            waiting = set(pool.who.tolist())
            ids, names = {k: v for k, v in ids.items() if k in waiting}, {k: v for k, v in names.items() if k in waiting}
        for sequence in pool.fill(0):
            yield rows(without_padding([sequence], limits))

    return base.mapInArrow(run, SCHEMA)
