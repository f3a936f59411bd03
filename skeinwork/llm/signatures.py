"""Word shingles as weighted sets, and BagMinHash signatures of them, for whole Arrow batches."""

from __future__ import annotations

import numpy as np

from .common import mix64, word_hashes, word_ids

_BITS = np.uint64(48)
_MASK = np.uint64((1 << 48) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight): the distinct `width`-word windows of each of n rows, by row, with how often each occurs.

    A row of fewer words is one window of all its words; a row without words has none. Shingles are 48-bit hashes.
    """
    out = []
    step = 1 << 15
    per_row = np.bincount(rows, minlength=n)
    ids, distinct = word_ids(data, starts, ends)
    words = word_hashes(distinct)[ids] if len(ids) else np.zeros(0, np.uint64)
    hashed = np.zeros(len(words), np.uint64)
    for k in range(width):
        hashed[: len(words) - k] = (hashed[: len(words) - k] * _STEP) + words[k:] if len(words) > k else hashed[: len(words) - k]
    first = np.cumsum(per_row) - per_row
    last = np.zeros(len(words), bool)
    if len(words) >= width:
        last[: len(words) - width + 1] = rows[: len(words) - width + 1] == rows[width - 1 :]
    at = np.flatnonzero(last)
    short = np.flatnonzero((per_row > 0) & (per_row < width))
    h = np.zeros(len(short), np.uint64)
    for k in range(width):
        has = per_row[short] > k
        h[has] = h[has] * _STEP + words[first[short[has]] + k]
    row = np.concatenate([rows[at], short])
    key = np.concatenate([mix64(hashed[at]), mix64(h + per_row[short].astype(np.uint64))]) >> np.uint64(16)
    if len(short):
        order = np.argsort(row, kind="stable")
        row, key = row[order], key[order]
    for r0 in range(0, max(n, 1), step):  # rows fit the upper 16 bits
        a, b = np.searchsorted(row, [r0, r0 + step])
        packed = np.sort((row[a:b] - r0).astype(np.uint64) << _BITS | key[a:b])
        new = np.ones(len(packed), bool)
        new[1:] = packed[1:] != packed[:-1]
        where = np.flatnonzero(new)
        out.append(((packed[where] >> _BITS).astype(np.int64) + r0, packed[where] & _MASK, np.diff(np.append(where, len(packed)))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def bag_minhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """BagMinHash: (n, size) signatures; two agree in a place with the probability of their rows' weighted Jaccard.

    Weights are whole numbers, so the discretised weights are 0, 1, 2, 4, 8 ...: each element has one Poisson process
    for each stretch (0,1], (1,2], (2,4], (4,8] ... that begins below its weight, with a rate of the stretch's length in
    every place. A point has a time, a place and a weight in its stretch; it counts if that is within the element's
    weight. A signature holds the earliest time in each place. Times run up to a horizon by which a row of that total
    weight has nearly surely filled every place; the rows that have not (and only they) run again, twice as far. So
    points are made in time order, about size * (log(size) + 3) a row, whatever its weights. Rows without elements
    get infinity.
    """
    sig = np.full((n, size), np.inf)
    if not len(row):
        return sig
    total = np.bincount(row, weight, n)
    levels = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    which = np.repeat(np.arange(len(row)), levels)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
    length = np.where(level == 0, 1, 2.0 ** np.maximum(level - 1, 0))
    below = np.where(level == 0, 0, length)
    seed = mix64(element[which] * np.uint64(64) + level.astype(np.uint64))
    r, limit, rate = row[which], weight[which], length * size
    horizon = (np.log(size) + 3) / np.maximum(total, 1)
    todo = np.ones(n, bool)
    while todo.any():
        on = np.flatnonzero(todo[r])
        if not len(on):
            break
        t = np.zeros(len(on))
        k = 0
        while len(on):
            k += 1
            h = mix64(seed[on] + np.uint64(k * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
            u = ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
            t = t - np.log(u) / rate[on]
            alive = t <= horizon[r[on]]
            on, t, h = on[alive], t[alive], h[alive]
            g = mix64(h ^ np.uint64(0xD6E8FEB86659FD93))
            place = ((g >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            spot = below[on] + np.ceil(((g & np.uint64(0xFFFFFFFF)).astype(np.float64) + 1) * 2.0**-32 * length[on])
            ok = spot <= limit[on]
            np.minimum.at(sig.reshape(-1), r[on][ok] * size + place[ok], t[ok])
        todo &= np.isinf(sig).any(axis=1) & (total > 0)
        horizon *= 2
    return sig


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """(rows, bands) 64-bit keys: equal where all of a band's places are."""
    places = sig.view(np.uint64).reshape(len(sig), bands, sig.shape[1] // bands)
    key = np.zeros((len(sig), bands), np.uint64)
    for k in range(places.shape[2]):
        key = mix64(key * _STEP + places[:, :, k])
    return (key + np.arange(bands, dtype=np.uint64) * _STEP).view(np.int64)


def minhash_bits(sig: np.ndarray) -> np.ndarray:
    """(rows, places / 64) longs that hold one bit of each place of signatures."""
    bits = (mix64(sig.view(np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64).reshape(len(sig), sig.shape[1] // 64)


def minhash(row: np.ndarray, element: np.ndarray, n: int, size: int) -> np.ndarray:
    """(n, size) MinHash values of plain sets, elements by row; a row without elements gets the greatest value."""
    sig = np.full((n, size), np.iinfo(np.uint64).max)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
    for k in range(size if len(row) else 0):
        sig[row[first], k] = np.minimum.reduceat(mix64(element ^ mix64(np.array([k + 1], np.uint64))), first)
    return sig
