"""Lower-cased words of Arrow batches and CRC-32 of their one- and two-word features, in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import flat_bytes, word_ids, word_spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words: digits, a-z (A-Z is lowered before), and every byte of a code point beyond ASCII.
_INK = np.zeros(256, bool)
_INK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def lowered(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with A-Z lowered, and byte starts, byte ends and rows of the words."""
    low = _LOWER[data]
    return low, *word_spans(low, bounds, _INK[low])


def pieces(column: pa.ChunkedArray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, bool]]:
    """(bytes, bounds, first row, whether it goes on a row): rows together up to `limit` bytes, a longer row in cuts
    between words, so that memory follows the limit and not the longest text (a single longer word stays whole)."""
    data, bounds = flat_bytes(column)
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        a, b = int(bounds[first]), int(bounds[last])
        if b - a <= limit:
            yield data[a:b], bounds[first : last + 1] - a, first, False
        else:
            at, on = a, False
            while at < b:
                to = min(at + limit, b)
                while to < b and _INK[_LOWER[data[to]]]:  # a window at a time, so that long words cost no step for each byte
                    gaps = np.flatnonzero(~_INK[_LOWER[data[to : min(to + 4096, b)]]])
                    to = to + int(gaps[0]) if len(gaps) else min(to + 4096, b)
                yield data[at:to], np.array([0, to - at]), first, on
                at, on = to, True
        first = last


def _crc_step() -> np.ndarray:
    """CRC-32 of single bytes by its reversed polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_LONG = 64  # words of more bytes are gone through byte by byte


def _crc_shifts() -> np.ndarray:
    """[length, place, byte]: what the byte at this place of a CRC becomes when `length` zero bytes follow."""
    step, out = _crc_step(), np.empty((_LONG + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for k in range(_LONG):
        out[k + 1] = (out[k] >> 8) ^ step[out[k] & 255]
    return out


_SHIFTS = _crc_shifts()


def feature_crcs(data: np.ndarray, bounds: np.ndarray, before: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int | None]:
    """Rows and CRC-32 of all single words and all pairs of neighbours (joined by a space), and the rows' word counts.

    A CRC of two words is the first's, moved on by the second's length, xor the second's: CRC is linear, so no pair's
    bytes are put together. `before` is the CRC of the word before a row that goes on, with its space; the last value
    is the same for the piece that follows.
    """
    low, starts, ends, rows = lowered(data, bounds)
    n = np.bincount(rows, minlength=len(bounds) - 1)
    if not len(starts):
        return rows, np.zeros(0, np.uint32), n, before
    ids, distinct = word_ids(low, starts, ends)
    words = distinct.to_pylist()
    one = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    spaced = np.fromiter((zlib.crc32(b" ", c) for c in one.tolist()), np.uint32, len(words))[ids]
    size = np.fromiter(map(len, words), np.int64, len(words))[ids]
    second = np.flatnonzero(rows[1:] == rows[:-1]) + 1
    first = spaced[second - 1]
    if before is not None:
        second, first = np.append(second, 0), np.append(first, np.uint32(before))
    length = size[second]
    short = np.minimum(length, _LONG)
    two = one[ids[second]].copy()
    for k in range(4):
        two ^= _SHIFTS[short, k, (first >> np.uint32(8 * k)) & 255]
    for k in np.flatnonzero(length > _LONG):
        two[k] = zlib.crc32(words[ids[second[k]]], int(first[k]))
    return np.concatenate([rows, rows[second]]), np.concatenate([one[ids], two]), n, int(spaced[-1])
