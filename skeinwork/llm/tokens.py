"""Encoding whole texts with public tokenizers inside tasks: distinct words of a batch once, then gathered.

Both tokenizers cut at white space before they merge anything, so a text's ids are the ids of its words in order:
a batch's distinct words are encoded in one call and every word looks its ids up. Words met before in the same worker
come from a bounded cache. Nothing is cut off, however long a text or a word is.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import flat_bytes, word_ids, word_spans

#: Words each worker remembers; when there would be more, it starts anew from its last batch.
CACHE_WORDS = 600_000


class _Known:
    """Words met before in this worker, as Arrow and numpy arrays: their ids end to end, and how many each has."""

    def __init__(self) -> None:
        self.words, self.flat, self.size = pa.array([], pa.large_binary()), np.zeros(0, np.uint16), np.zeros(0, np.int64)

    def look_up(self, distinct: pa.Array, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, first, size): each distinct word's ids are flat[first : first + size]; unknown words are encoded in one call."""
        at = pc.index_in(distinct, value_set=self.words)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = distinct.take(pa.array(new))
        flat, size = encode(fresh) if len(new) else (np.zeros(0, np.uint16), np.zeros(0, np.int64))
        known = len(self.words)
        at[new] = known + np.arange(len(new))
        if known + len(new) > CACHE_WORDS and known:
            all_flat, all_size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
            first = np.cumsum(all_size) - all_size
            out = all_flat, first[at], all_size[at]
            self.__init__()
            self._add(fresh, flat, size)
            return out
        self._add(fresh, flat, size)
        first = np.cumsum(self.size) - self.size
        return self.flat, first[at], self.size[at]

    def _add(self, words: pa.Array, flat: np.ndarray, size: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])


#: Of ASCII bytes: 1 letters, 2 digits, 3 other signs, 4 the apostrophe; 0 all else.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[39] = 4

_caches: dict[str, _Known] = {}
_models: dict[str, object] = {}


def tokenizer(path: str):
    """A tokenizers-library model, loaded once in each worker."""
    if path not in _models:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on each core already
        from tokenizers import Tokenizer

        _models[path] = Tokenizer.from_file(path)
    return _models[path]


def sentence_pieces(path: str):
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def _pieces(data: np.ndarray, bounds: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the pieces between the bytes marked in cut, which belong to none; a row has one at least."""
    at = np.flatnonzero(cut)
    row_at = np.searchsorted(bounds, at, side="right") - 1
    n = len(bounds) - 1
    starts = np.concatenate([bounds[:-1], at + 1])
    ends = np.concatenate([bounds[1:], at])
    rows = np.concatenate([np.arange(n), row_at])
    order = np.lexsort((starts, rows))
    rows = rows[order]
    ends_rows = np.concatenate([row_at, np.arange(n)])
    ends = np.concatenate([at, bounds[1:]])[np.lexsort((np.concatenate([at, bounds[1:]]), ends_rows))]
    return starts[order], ends, rows


def _word_bpe(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, end to end, and how many each has. Words of letters alone go in long lines of many: such a word
    is one run of the model's pre-tokenizer, so exactly its last id is one that ends a word, which tells them apart.
    The normalizer leaves words of a to z as they are and the pre-tokenizer cuts them at spaces alone, so that lines of
    these need the library's BPE model only."""
    model = tokenizer(path)
    if path + "#ends" not in _models:
        from tokenizers import Tokenizer, pre_tokenizers

        _models[path + "#ends"] = np.array([t.endswith("</w>") for t, _ in sorted(model.get_vocab().items(), key=lambda x: x[1])])
        _models[path + "#plain"] = Tokenizer(model.model)
        _models[path + "#plain"].pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    ends, plain_model = _models[path + "#ends"], _models[path + "#plain"]
    data, bounds = flat_bytes(words)
    other = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data < 97) | (data > 122), out=other[1:])
    is_plain = (other[bounds[1:]] == other[bounds[:-1]]) & (bounds[1:] > bounds[:-1])
    flat, size, order, rest = [], [], [], np.flatnonzero(~is_plain).tolist()

    def take(lines: list, found: list) -> None:
        for line, e in zip(lines, found, strict=True):
            ids = np.array(e.ids, np.uint16)
            stop = np.flatnonzero(ends[ids]) + 1
            if len(stop) != len(line):  # not one run each, after all
                rest.extend(line)
                continue
            flat.append(ids)
            size.append(np.diff(stop, prepend=0))
            order.append(np.array(line))

    plain = np.flatnonzero(is_plain)
    letters, at = flat_bytes(words.take(pa.array(plain)))
    text = np.full(len(letters) + len(plain), 32, np.uint8)  # a space after each word
    text[np.arange(len(letters)) + np.repeat(np.arange(len(plain)), np.diff(at))] = letters
    at = at + np.arange(len(plain) + 1)
    cuts = list(range(0, len(plain), 512)) + [len(plain)]
    take([plain[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], plain_model.encode_batch_fast([text[at[a] : at[b] - 1].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], add_special_tokens=False))
    spelt = dict(zip(rest, words.take(pa.array(rest, pa.int64())).cast(pa.large_string()).to_pylist(), strict=True))
    alpha, rest = [k for k, w in spelt.items() if w.isalpha()], [k for k, w in spelt.items() if not w.isalpha()]
    lines = [alpha[i : i + 512] for i in range(0, len(alpha), 512)]
    take(lines, model.encode_batch_fast([" ".join([spelt[k] for k in line]) for line in lines], add_special_tokens=False))
    for k, e in zip(rest, model.encode_batch_fast([spelt[k] for k in rest], add_special_tokens=False), strict=True):
        flat.append(np.array(e.ids, np.uint16))
        size.append(np.array([len(e.ids)]))
        order.append(np.array([k]))
    flat, size, order = np.concatenate(flat), np.concatenate(size), np.concatenate(order)
    first = np.cumsum(size) - size
    back = np.argsort(order)
    return flat[_spread(first[back], size[back])], size[back]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... size[0] of them, then from first[1], and so on."""
    total = np.cumsum(size)
    return np.repeat(first - (total - size), size) + np.arange(total[-1] if len(total) else 0)


def word_bpe_ids(texts: pa.ChunkedArray | pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds): ids of all texts end to end (uint16: the vocabulary has 49,408) and where each text's begin.

    As Tokenizer.encode(text, add_special_tokens=False) gives them; strings of special tokens inside a text become
    their ids, as is its default. This model drops white space, lowers letters and merges within words only; letters,
    digits (each alone) and other signs are words apart, but for an apostrophe and what follows it.
    """
    data, bounds = flat_bytes(texts)
    n = len(bounds) - 1
    ink = (data != 32) & (data != 10)
    breaks = None
    if not ((data[:-1] == 60) & (data[1:] == 124)).any():  # no "<|", so no special token's string
        kind = _KIND[data]
        data = np.where((data >= 65) & (data <= 90), data | 32, data)
        letter = kind == 1
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        breaks = np.zeros(len(data), bool)
        breaks[1:] = letter[:-1] & (kind[1:] >= 3) | (kind[:-1] == 3) & (kind[1:] == 1) | (kind[1:] == 2) | (kind[:-1] == 2)
    starts, ends, rows = word_spans(data, bounds, ink, breaks)
    words, distinct = word_ids(data, starts, ends)
    flat, first, size = _caches.setdefault(path, _Known()).look_up(distinct, lambda w: _word_bpe(path, w))
    each = size[words]
    ids = flat[_spread(first[words], each)]
    out = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(rows, each, n).astype(np.int64), out=out[1:])
    return ids, out


def piece_bpe_counts(texts: pa.ChunkedArray | pa.Array, path: str) -> np.ndarray:
    """Tokens of each text as SentencePieceProcessor.encode(text) gives them, without begin or end.

    No piece of this model has a space mark after another character, so a cut before a run of spaces is safe: the run's
    first space is what the model puts before any text it is given. Texts that hold the mark itself (U+2581) are
    encoded whole.
    """
    data, bounds = flat_bytes(texts)
    n = len(bounds) - 1
    cut = data == 32
    cut[1:] &= data[:-1] != 32
    heads = bounds[:-1][bounds[:-1] < len(data)]
    cut[heads] = False
    model = sentence_pieces(path)
    starts, ends, rows = _pieces(data, bounds, cut)
    words, distinct = word_ids(data, starts, ends)
    # the "ids" kept for a piece are its count, in two 16-bit halves
    halves = lambda w: (np.array([len(x) for x in model.encode(w.cast(pa.large_string()).to_pylist(), num_threads=1)], np.uint32).view(np.uint16), np.full(len(w), 2, np.int64))
    flat, first, _ = _caches.setdefault(path, _Known()).look_up(distinct, halves)
    counts = flat[first].astype(np.int64) + (flat[first + 1].astype(np.int64) << 16) if len(first) else np.zeros(0, np.int64)
    each = counts[words]
    lone = (ends == starts) & np.append(False, rows[1:] == rows[:-1])  # a last single space: the mark alone
    each = np.where(lone, len(model.encode("a ")) - len(model.encode("a")), each)
    out = np.bincount(rows, each, n).astype(np.int64)
    mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else []
    for r in np.unique(np.searchsorted(bounds, mark, side="right") - 1).tolist() if len(mark) else []:
        out[r] = len(model.encode(bytes(data[bounds[r] : bounds[r + 1]]).decode()))
    return out
