"""Adaptive context-mixing range coder for token ids, in independently reset blocks.

A block is cut into strands of equal length, which share one model, and all strands of a group of blocks are coded side
by side: step t codes id t of every strand, so numpy works on one value of each strand at a time. A block's model
starts from fixed shares and sees only what its strands coded in earlier steps:

* order 2 and order 1: for the (hashed) ids before, the id that last followed and how often running it was right;
* order 0: the counts of the block's first 2**k ids, k as large as possible;
* order -1: all ids alike.

For each pair of confidences the block counts which order was right; from these counts, taken anew whenever k grows,
come the shares (of 2**16) by which the four predictions mix: nested parts of an interval of 2**32, one stretch for each
id. A 64-bit range coder narrows to it and gives out 16-bit words; carries are added afterwards, from the last word back.
A block's bytes are how many words each strand has, then the strands' words. A last block that is not full is coded as if
ids 0 filled it.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096
#: Strands of a block, and blocks side by side: wide enough for numpy, and small enough for a core's share of the caches.
_STRANDS, _SIDE = 16, 128
_FIRST = 16  # ids before order 0 begins
_AT_ONCE = 1 << 15  # ids whose intervals the encoder makes at once
_SLOTS1, _SLOTS2 = 11, 12  # bits of a block's hash tables
_NONE, _SAME = 4, 5  # in place of a confidence: no guess yet; order 1 guesses what order 2 does
_SURE, _WHEN = 16, 19  # a slot: the id, from these bits on its confidence and when it was written
_EMPTY = _NONE << _SURE | 0xFFFF
_TOTAL = 1 << 16
_SMALL = np.uint64(1 << 48)
_ONE, _U16, _U32, _U48 = np.uint64(1), np.uint64(16), np.uint64(32), np.uint64(48)
#: What is thought before anything is counted: of 32, how often a guess of confidence 0 to 3 is right; order 0.
_PRIOR = np.array([3, 9, 16, 22, 0, 0, 0, 0])
_PRIOR0 = 20


class _Shares:
    """For each block and pair of confidences, the shares of the orders, from how often each was right."""

    def __init__(self, blocks: int, strands: int) -> None:
        self.block = np.repeat(np.arange(blocks, dtype=np.int64), strands)  # of each strand
        self.base = self.block << 6
        f2, f1 = np.divmod(np.arange(64), 8)
        # right[order][block, confidences] and tried: a prior of 32 tries
        self.right = [np.tile(c.astype(np.int64), (blocks, 1)) for c in (_PRIOR[f2], _PRIOR[f1], np.full(64, _PRIOR0))]
        self.tried = [np.full((blocks, 64), 32, np.int64) for _ in range(3)]
        self.never = (f2 == _NONE, (f1 == _NONE) | (f1 == _SAME))
        self.weigh(False)

    def weigh(self, order0: bool) -> None:
        share = [np.clip((r << 16) // t, 2048, 63488) for r, t in zip(self.right, self.tried, strict=True)]
        for o in (0, 1):
            share[o][:, self.never[o]] = 0
        w2 = share[0]
        w1 = (_TOTAL - w2) * share[1] >> 16
        rest = _TOTAL - w2 - w1
        w0 = rest * share[2] >> 16 if order0 else np.zeros_like(rest)
        self.first, self.w0 = (w.reshape(-1).astype(np.uint32) for w in (w2 | w2 + w1 << 16, w0))

    def split(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where order 2 and order 1 end, and how much order 0 has."""
        first = self.first.take(at)
        return first & 0xFFFF, first >> 16, self.w0.take(at)

    def count(self, seen: np.ndarray, order0: bool) -> None:
        """After a segment: how often each place of (base + confidences) << 2 | order was taken (0: order 2, 1: order 1,
        2: order 0, 3: none)."""
        n = seen.reshape(-1, 64, 4)
        left = n.sum(axis=2)
        for o in range(3 if order0 else 2):
            self.right[o] += n[:, :, o]
            self.tried[o] += left
            left = left - n[:, :, o]


class _Model(_Shares):
    """What all blocks know at one step of decoding. guess() gives what follows, learn() takes the ids.

    Where strands of a block write one slot in one step, the last strand's word stays.
    """

    def __init__(self, blocks: int, strands: int, kind: type) -> None:
        super().__init__(blocks, strands)
        self.base1, self.base2 = self.block << _SLOTS1, self.block << _SLOTS2
        empty = np.iinfo(kind).min + _EMPTY
        self.last1, self.last2 = np.full(blocks << _SLOTS1, empty, kind), np.full(blocks << _SLOTS2, empty, kind)
        self.mixed = self.part = np.zeros(len(self.block), np.uint32)
        self.when = np.tile(np.arange(strands, dtype=kind) << kind(_WHEN), blocks)
        self.step = kind(strands << _WHEN)

    def guess(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids that order 2 and order 1 guess, and the place of their confidences."""
        self.at1 = self.base1 + (self.mixed >> 5 & ((1 << _SLOTS1) - 1))
        self.at2 = self.base2 + ((self.mixed >> 4 ^ self.part) & ((1 << _SLOTS2) - 1))
        self.e1, self.e2 = e1, e2 = self.last1.take(self.at1), self.last2.take(self.at2)
        c1, c2 = e1 & 0xFFFF, e2 & 0xFFFF
        return c2, c1, self.base + ((e2 >> (_SURE - 3) & 7 << 3) + np.where(c1 == c2, e1.dtype.type(_SAME), e1 >> _SURE & 7))

    def learn(self, x: np.ndarray, right2: np.ndarray, right1: np.ndarray) -> None:
        fresh = self.when + x
        for last, at, e, right in ((self.last2, self.at2, self.e2, right2), (self.last1, self.at1, self.e1, right1)):
            np.maximum.at(last, at, fresh + np.minimum((e & 7 << _SURE) + (1 << _SURE), 3 << _SURE) * right)
        self.when = self.when + self.step
        self.part = self.mixed >> 9
        self.mixed = x.astype(np.uint32) * np.uint32(40503)


def _strands(block: int) -> int:
    if not 0 < block <= 1 << 16:
        raise ValueError(f"blocks of {block} ids; 1 to {1 << 16} can be coded")
    strands = _STRANDS
    while block % strands or block < strands * _FIRST and strands > 1:
        strands //= 2
    return strands


def _groups(blocks: int):
    """Ranges of at most _SIDE blocks, as even as can be."""
    n = -(-blocks // _SIDE)
    for k in range(n):
        yield slice(blocks * k // n, blocks * (k + 1) // n)


def _segments(steps: int, strands: int):
    """(from step, to step, log2 of the ids that order 0 has counted, or -1)."""
    t = max(_FIRST // strands, 1)
    yield 0, min(t, steps), -1
    while t < steps:
        yield t, min(2 * t, steps), (t * strands).bit_length() - 1
        t *= 2


def _by_step(of_blocks: np.ndarray, strands: int) -> np.ndarray:
    """A row for each step, from a row for each block in order of (step, strand)."""
    blocks = len(of_blocks)
    return np.ascontiguousarray(of_blocks.reshape(blocks, -1, strands).transpose(1, 0, 2)).reshape(-1, blocks * strands)


def _history(ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a block's sorted first 2**k ids: its id and where its run of equal ids begins (<< 16), and how
    long that is, both of 2**16."""
    ranked = np.sort(ids, axis=1, kind="stable")
    n, m = ranked.shape
    new = np.ones((n, m), bool)
    new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    begin = np.flatnonzero(new)
    size = np.diff(begin, append=n * m)
    runs = ranked[new] | (begin & m - 1) << 32 - k
    return np.repeat(runs.astype(np.uint32), size), np.repeat((size << 16 - k).astype(np.uint32), size)


def _history_ranks(ids: np.ndarray, m: int) -> np.ndarray:
    """For ids from m on: how many of the block's first m ids are less (<< 16), and how many less or equal."""
    if len(ids) > 16:
        return np.concatenate([_history_ranks(ids[k : k + 16], m) for k in range(0, len(ids), 16)])
    n, width = ids.shape
    key = (ids.astype(np.uint32) << 16) | np.arange(width, dtype=np.uint32)
    key.sort(axis=1)
    value, place = key >> 16, (key & 0xFFFF).reshape(-1)
    late = place >= m
    new = np.ones((n, width), bool)
    new[:, 1:] = value[:, 1:] != value[:, :-1]
    begin = np.flatnonzero(new)
    ends = np.append(begin[1:], n * width)
    known = np.zeros(n * width + 1, np.uint32)
    np.cumsum(~late, out=known[1:])
    both = known[begin] - (begin // width * m).astype(np.uint32)
    both = both << 16 | both + (known[ends] - known[begin])
    each = np.repeat(both, ends - begin)
    late = np.flatnonzero(late)
    out = np.empty((n, width - m), np.uint32)
    out.reshape(-1)[late // width * (width - m) + (place[late] - np.uint32(m))] = each[late]
    return out


def _guesses(slots: np.ndarray, ids: np.ndarray, strands: int) -> np.ndarray:
    """What one order guesses at each id, and how sure it is (<< _SURE), from at most 16 whole blocks (rows in order of time):
    what the last strand that wrote the slot in an earlier step wrote."""
    n, block = ids.shape
    key = slots << 16 | np.arange(block, dtype=np.uint32)
    key.sort(axis=1)
    key |= np.arange(n, dtype=np.uint32)[:, None] << 28
    key = key.reshape(-1)
    place = (key >> 28).astype(np.int64) * block + (key & 0xFFFF)
    met = key >> (strands.bit_length() - 1)  # alike for ids of a slot and step
    last = np.append(np.flatnonzero(met[1:] != met[:-1]), len(key) - 1)
    slot, wrote = key[last] >> 16, ids.reshape(-1)[place[last]]
    other = np.ones(len(last), bool)  # not the slot of the writer before
    other[1:] = slot[1:] != slot[:-1]
    new = other.copy()
    new[1:] |= wrote[1:] != wrote[:-1]
    at = np.arange(len(last), dtype=np.int32)
    run = at - np.maximum.accumulate(np.where(new, at, 0))
    guess = np.full(len(last), _EMPTY, np.int32)
    guess[1:] = np.where(other[1:], _EMPTY, np.minimum(run[:-1], 3) << _SURE | wrote[:-1])
    out = np.empty(n * block, np.int32)
    out[place] = np.repeat(guess, np.diff(last, prepend=-1))
    return out.reshape(n, block)


def _foreseen(timed: np.ndarray, strands: int) -> tuple[np.ndarray, np.ndarray]:
    """(step, strand): the pair of confidences, and which order is right (0: order 2, 1: order 1, 2: neither).

    The encoder knows all ids, so what decode() learns step by step comes from sorting each block by slots.
    """
    cell, right = np.empty(timed.shape, np.uint8), np.empty(timed.shape, np.uint8)
    for k in range(0, len(timed), 16):
        ids = timed[k : k + 16]
        mixed, part = np.zeros(ids.shape, np.uint32), np.zeros(ids.shape, np.uint32)
        mixed[:, strands:] = ids[:, :-strands].astype(np.uint32) * np.uint32(40503)
        part[:, strands:] = mixed[:, :-strands] >> 9
        e1 = _guesses(mixed >> 5 & ((1 << _SLOTS1) - 1), ids, strands)
        e2 = _guesses((mixed >> 4 ^ part) & ((1 << _SLOTS2) - 1), ids, strands)
        c1, c2 = e1.astype(np.uint16), e2.astype(np.uint16)
        cell[k : k + 16] = (e2 >> _SURE << 3) + np.where(c1 == c2, _SAME, e1 >> _SURE)
        right[k : k + 16] = np.where(ids == c2, np.uint8(0), np.where(ids == c1, np.uint8(1), np.uint8(2)))
    return _by_step(cell, strands), _by_step(right, strands)


def encode(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """One byte string for each block of `block` ids; ids are below 65,535."""
    strands, n = _strands(block), len(ids)
    blocks = -(-n // block)
    grid = np.zeros(blocks * block, np.uint16)
    grid[:n] = ids
    grid = grid.reshape(blocks, strands, block // strands)
    return [part for group in _groups(blocks) for part in _encode_group(grid[group])]


def _encode_group(grid: np.ndarray) -> list[bytes]:
    blocks, strands, steps = grid.shape
    timed = np.ascontiguousarray(grid.transpose(0, 2, 1)).reshape(blocks, -1)
    ids = _by_step(timed, strands)
    lanes = blocks * strands
    cap = 2 * steps + 8
    out = np.zeros(lanes * cap, np.uint64)
    begin = np.arange(lanes, dtype=np.int64) * cap
    at = begin
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    model = _Shares(blocks, strands)
    cells, rights = _foreseen(timed, strands)
    at_once = max(_AT_ONCE // lanes, 1)
    for t0, t1, k in _segments(steps, strands):
        ranks = _by_step(_history_ranks(timed[:, : t1 * strands], t0 * strands), strands) if k >= 0 else None
        seen = np.zeros(model.tried[0].size * 4, np.int64)
        for p in range(t0, t1, at_once):
            q = min(p + at_once, t1)
            where = model.base + cells[p:q]
            w2, lead, w0 = model.split(where)
            right = rights[p:q]
            a = ids[p:q].astype(np.uint32)
            if k >= 0:
                upto = ranks[p - t0 : q - t0]
                less = upto >> 16
                n = (upto & 0xFFFF) - less
                known = n > 0
                width = np.where(known, w0 << (16 - k), _TOTAL - lead - w0)
                start = (np.where(known, lead, lead + w0) << 16) + width * np.where(known, less, a)
                size = np.where(known, width * n, width)
            else:
                known = np.zeros(a.shape, bool)
                size = _TOTAL - lead
                start = (lead << 16) + size * a
            h2, h21 = right == 0, right < 2
            start = np.where(h21, np.where(h2, 0, w2 << 16), start)
            size = np.where(h21, np.where(h2, w2, lead - w2) << 16, size)
            if t1 < steps:  # what the last segment shows is of no more use
                taken = np.where(h21, right, 3 - known.view(np.uint8))
                seen += np.bincount((where << 2 | taken).reshape(-1), minlength=len(seen))
            for t in range(q - p):
                unit = span >> _U32
                before = low
                low = low + unit * start[t]
                carry = np.flatnonzero(low < before)
                if len(carry):
                    out[at[carry] - 1] += _ONE
                span = unit * size[t]
                small = span < _SMALL
                out[at] = low >> _U48  # stays where span is small, else it is written over
                shift = small.astype(np.uint64) << np.uint64(4)
                low, span, at = low << shift, span << shift, at + small
                small = np.flatnonzero(span < _SMALL)
                while len(small):
                    out[at[small]] = low[small] >> _U48
                    low[small] <<= _U16
                    span[small] <<= _U16
                    at[small] += 1
                    small = small[span[small] < _SMALL]
        if t1 < steps:
            model.count(seen, k >= 0)
            model.weigh(True)
    # one more word, with zeros after it, is within what is left: that is 2**48 at least
    before = low
    low = low + (_SMALL - _ONE)
    out[at[low < before] - 1] += _ONE
    out[at] = low >> _U48
    return _words(out.reshape(lanes, cap), at + 1 - begin, strands)


def _words(words: np.ndarray, sizes: np.ndarray, strands: int) -> list[bytes]:
    words = np.ascontiguousarray(words[:, : int(sizes.max())].T)
    for p in range(len(words) - 1, 0, -1):  # carries, from the last word back
        words[p - 1] += np.where(p < sizes, words[p] >> _U16, np.uint64(0))
    words = words.T.astype(">u2")
    flat = words[np.arange(words.shape[1]) < sizes[:, None]]
    sizes = sizes.reshape(-1, strands)
    heads, ends = sizes.astype(">u2"), np.cumsum(sizes.sum(axis=1)).tolist()
    return [head.tobytes() + flat[a:b].tobytes() for head, a, b in zip(heads, [0, *ends[:-1]], ends, strict=True)]


def decode(parts: list[bytes], n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids (uint16) of encode()'s byte strings."""
    blocks = -(-n // block)
    out = np.empty((blocks, block), np.uint16)
    for group in _groups(blocks):
        out[group] = _decode_group(parts[group], block)
    return out.reshape(-1)[:n]


def _decode_group(parts: list[bytes], block: int) -> np.ndarray:
    strands, blocks = _strands(block), len(parts)
    steps, lanes = block // strands, blocks * strands
    sizes = np.concatenate([np.frombuffer(p, ">u2", strands) for p in parts]).astype(np.int64)
    ends = np.cumsum(sizes)
    words = np.zeros(int(ends[-1]) + 4 * lanes, np.uint64)  # four zeros after each strand's words
    words[np.arange(ends[-1]) + np.repeat(4 * np.arange(lanes), sizes)] = np.concatenate([np.frombuffer(p, ">u2", offset=2 * strands) for p in parts])
    at = ends - sizes + 4 * np.arange(lanes)
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = code << _U16 | words.take(at)
        at = at + 1
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    kind = np.int32 if block <= 1 << (31 - _WHEN) else np.int64
    model = _Model(blocks, strands, kind)
    out = np.zeros((steps, lanes), np.uint16)
    top = np.uint64((1 << 32) - 1)
    for t0, t1, k in _segments(steps, strands):
        if k >= 0:
            begins, lengths = _history(out[:t0].reshape(t0, blocks, strands).transpose(1, 0, 2).reshape(blocks, -1), k)
            row = model.block << k
        counted = t1 < steps
        shape = (t1 - t0 if counted else 0, lanes)
        where, taken = np.zeros(shape, np.int64), np.zeros(shape, np.int8)
        for t in range(t0, t1):
            c2, c1, place = model.guess()
            w2, lead, w0 = model.split(place)
            unit = span >> _U32
            y = np.minimum(code // unit, top).astype(np.uint32)
            y16 = y >> 16
            h2, h21 = y16 < w2, y16 < lead
            if k >= 0:
                upto = lead + w0
                h0 = y16 < upto  # or h21: what follows for these is not used
                width = np.where(h0, w0, _TOTAL - upto)
                start = np.where(h0, lead, upto) << 16
                v = (y - start) // width
                at0 = row + (v >> (16 - k) & (1 << k) - 1)
                run = np.where(h0, begins.take(at0), v * 65537)
                x, start, size = run & 0xFFFF, start + width * (run >> 16), width * np.where(h0, lengths.take(at0), 1)
            else:
                h0, size, start = h21, _TOTAL - lead, lead << 16
                x = (y - start) // size
                start = start + size * x
            x = np.where(h21, np.where(h2, c2, c1), x.astype(kind))
            start = np.where(h21, np.where(h2, 0, w2 << 16), start)
            size = np.where(h21, np.where(h2, w2, lead - w2) << 16, size)
            if counted:
                where[t - t0] = place
                taken[t - t0] = 3 - h0.view(np.int8) - h21.view(np.int8) - h2.view(np.int8)
            model.learn(x, h2, x == c1)
            out[t] = x
            code = code - unit * start
            span = unit * size
            small = span < _SMALL
            code = np.where(small, code << _U16 | words.take(at), code)
            span, at = span << (small.astype(np.uint64) << np.uint64(4)), at + small
            small = np.flatnonzero(span < _SMALL)
            while len(small):
                code[small] = code[small] << _U16 | words[at[small]]
                span[small] <<= _U16
                at[small] += 1
                small = small[span[small] < _SMALL]
        if counted:
            model.count(np.bincount((where << 2 | taken).reshape(-1), minlength=model.tried[0].size * 4), k >= 0)
            model.weigh(True)
    return out.reshape(steps, blocks, strands).transpose(1, 2, 0).reshape(blocks, block)
