"""Encoding whole texts through a cache of their words, in numpy.

A plain text has no white space but single spaces and line breaks between
words; it is cut before each of them, any other text is one unit.  Units are
told apart by 64-bit hashes.  The ids of known units lie in one pool, so a
block of texts is encoded by looking up its distinct units and gathering their
ids; only units that the worker has not seen are given to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from daymark.llm.words import _BASE, _BASE_INV, _BYTE, _powers, mix64, utf8

_U = np.uint64
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x0A]] = True
#: Other white space and control separators, and lead bytes that wider spaces and marks begin with.
_ODD = np.zeros(256, dtype=bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0xE1, 0xE2, 0xE3]] = True


#: Stops before which a word may be cut where the tokenizer never joins them to a letter.
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def unit_starts(raw: np.ndarray, off: np.ndarray, stops: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the units, and for each unit whether its text is plain.

    With ``stops`` a plain text is also cut between an ASCII letter and a stop."""
    n = len(raw)
    sep = _SEP[raw]
    odd = _ODD[raw]
    pair = (raw[:-1] == 0xC2) & ((raw[1:] == 0x85) | (raw[1:] == 0xA0))
    odd[:-1] |= pair
    odd[:-1] |= sep[:-1] & sep[1:]
    filled = np.flatnonzero(np.diff(off) > 0)
    first, last = off[filled], off[filled + 1] - 1
    odd[first] |= sep[first]
    odd[last] |= sep[last]
    bad = np.concatenate([[0], np.cumsum(odd)])
    plain = bad[last + 1] == bad[first]
    cut = sep
    if stops and n:
        cut = sep.copy()
        cut[1:] |= _STOP[raw[1:]] & _ASCII_LETTER[raw[:-1]]
        cut[first] &= sep[first]
    at = np.flatnonzero(cut)
    text = np.searchsorted(first, at, "right") - 1
    at = at[plain[text]] if len(first) else at[:0]
    starts = np.concatenate([first, at])
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    assert n == 0 or starts[0] == 0
    return starts, np.concatenate([plain, np.ones(len(at), dtype=bool)])[order]


class UnitCache:
    """``encode`` gives ids per text; ``encode_units`` gives them for units not yet known.

    ``encode_units(units, plain)`` takes byte strings and returns one id array
    each.  When the cache holds more than ``max_units`` units or eight times as
    many ids, those stay that were used in most blocks since the last time, half of them at most.
    """

    def __init__(self, encode_units: Callable[[list[bytes], np.ndarray], list[np.ndarray]], max_units: int = 800_000, stops: bool = False) -> None:
        self.encode_units = encode_units
        self.stops = stops
        self.max_units = max_units
        self.clear()

    def clear(self) -> None:
        self.levels = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]
        self.starts = np.zeros(1, np.int64)
        self.n_units = 0
        self.pool = np.zeros(1 << 16, np.int32)
        self.uses = np.zeros(1 << 16, np.uint8)

    def shrink(self) -> None:
        """Drop units of few uses, at least half of all; the others start at no use again."""
        uses = self.uses[: self.n_units]
        sizes = np.diff(self.starts)
        least = 2
        while least < 256 and ((keep := uses >= least).sum() > self.max_units // 2 or sizes[keep].sum() > 4 * self.max_units):
            least += 1
        if least == 256:
            self.clear()
            return
        fresh = np.cumsum(keep) - 1
        self.pool = self.pool[: self.starts[-1]][np.repeat(keep, sizes)]
        self.starts = np.concatenate([[0], np.cumsum(sizes[keep])])
        self.levels = [(known[keep[number]], fresh[number[keep[number]]]) for known, number in self.levels]
        self.n_units = int(keep.sum())
        self.uses = np.zeros(len(self.uses), np.uint8)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of known units, -1 for others; ``keys`` ascending."""
        found = np.full(len(keys), -1, np.int64)
        for known, number in self.levels:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                found[hit] = number[at[hit]]
        return found

    def _add(self, keys: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
        """Store units (ascending keys); their numbers."""
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        ends = self.starts[self.n_units] + np.cumsum(sizes)
        if ends[-1] > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(int(ends[-1]), np.int32)])
        self.pool[self.starts[self.n_units] : ends[-1]] = np.concatenate(ids)
        self.starts = np.concatenate([self.starts[: self.n_units + 1], ends])
        numbers = np.arange(self.n_units, self.n_units + len(ids))
        self.n_units += len(ids)
        if self.n_units > len(self.uses):
            self.uses = np.concatenate([self.uses, np.zeros(self.n_units, np.uint8)])
        into = 1 if len(self.levels[1][0]) + len(keys) < 200_000 else 0
        if into == 0:
            keys, numbers_ = np.concatenate([keys, self.levels[1][0]]), np.concatenate([numbers, self.levels[1][1]])
            self.levels[1] = (keys[:0], numbers[:0])
        else:
            numbers_ = numbers
        keys, numbers_ = np.concatenate([self.levels[into][0], keys]), np.concatenate([self.levels[into][1], numbers_])
        order = np.argsort(keys, kind="stable")
        self.levels[into] = (keys[order], numbers_[order])
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the n+1 offsets of the texts in them."""
        raw, off = utf8(texts)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        starts, plain = unit_starts(raw, off, self.stops)
        ends = np.append(starts[1:], len(raw))
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw)), out=sums[1:])
        hashes = mix64((sums[ends] - sums[starts]) * _powers(_BASE_INV, len(raw) + 1)[starts])
        del sums
        # A unit at the start of a text has no space before it and may be encoded in another way.
        first = np.searchsorted(off, starts, "right") - 1
        hashes[off[first] == starts] ^= _U(0x5BD1E995)
        # Distinct hashes by a hash table; only those are sorted.
        coded = pa.array(hashes).dictionary_encode()
        codes, keys = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        where = np.empty(len(keys), dtype=np.int64)
        where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        order = np.argsort(keys)
        keys, where = keys[order], where[order]
        number = self._find(keys)
        new = np.flatnonzero(number < 0)
        if self.n_units and (self.n_units + len(new) > self.max_units or self.starts[-1] > 8 * self.max_units):
            self.shrink()
            number = self._find(keys)
            new = np.flatnonzero(number < 0)
        if len(new):
            at = where[new]
            data = raw.tobytes()
            units = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            number[new] = self._add(keys[new], self.encode_units(units, plain[at]))
        self.uses[number] = np.minimum(self.uses[number], 254) + 1
        of_code = np.empty(len(order), dtype=np.int64)
        of_code[order] = number
        number = of_code[codes]
        begin = self.starts[number]
        size = self.starts[number + 1] - begin
        stop = np.cumsum(size)
        ids = self.pool[np.repeat(begin - (stop - size), size) + np.arange(stop[-1])]
        return ids, np.concatenate([[0], stop])[np.searchsorted(starts, off)]


__all__ = ["UnitCache", "unit_starts"]
