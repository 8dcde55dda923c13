"""Words and word shingles of whole Arrow string columns, in numpy.

A word is a run of ``[^\\x20\\x09-\\x0D]``; A-Z are lower-cased first (no other
letter is).  Both rules touch ASCII bytes only, so they are applied to the
UTF-8 bytes of a whole batch at once.  A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
_U = np.uint64
_rng = np.random.default_rng(20240229)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = int(_rng.integers(1, 2**61)) * 8 + 5
_BASE_INV = pow(_BASE, -1, 2**64)
_MULT = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_SHORT = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1): a row of 65,536 powers is kept, longer ones are made from it each time."""
    row = 1 << 16
    if base not in _POWERS:
        _POWERS[base] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(row - 1, _U(base))]))
    if n <= row:
        return _POWERS[base][:n]
    steps = np.full(-(-n // row), _U(pow(base, row, 2**64)))
    steps[0] = 1
    return (np.cumprod(steps)[:, None] * _POWERS[base]).ravel()[:n]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n+1 offsets of the texts in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text, or of one longer text."""
    _, off = utf8(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
        yield lo, min(hi, len(texts))
        lo = hi


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) bytes of every word, and the n+1 word offsets of the texts."""
    inside = _IS_WORD[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = off[1:-1][off[1:-1] < len(raw)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = off[1:-1][off[1:-1] > 0] - 1
    last[before] = inside[before]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every lower-cased word (polynomial over its bytes)."""
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * _powers(_BASE, len(raw)), out=sums[1:])
    return mix64((sums[end] - sums[start]) * _powers(_BASE_INV, len(raw) + 1)[start])


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, and their n+1 offsets.

    A text of one to four words has its whole sequence as its one shingle;
    a text without words has none.
    """
    raw, off = utf8(texts)
    start, end, at = word_spans(raw, off)
    words = word_hashes(raw, start, end)
    n = len(words)
    n_words = np.diff(at)
    hashed = np.zeros(n, dtype=np.uint64)
    if n >= SHINGLE:
        full = n - SHINGLE + 1
        for j in range(SHINGLE):
            hashed[:full] += words[j : j + full] * _MULT[j]
    keep = np.arange(n) + SHINGLE <= np.repeat(at[1:], n_words)
    for row in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)):
        own = words[at[row] : at[row + 1]]
        hashed[at[row]] = np.append(own * _MULT[: len(own)], _SHORT[len(own)]).sum(dtype=np.uint64)
        keep[at[row]] = True
    counts = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, (n_words > 0).astype(int))
    hashed = mix64(hashed[keep])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for row in range(len(n_words)):
        hashed[bounds[row] : bounds[row + 1]].sort()
    fresh = np.ones(len(hashed), dtype=bool)
    fresh[1:] = hashed[1:] != hashed[:-1]
    starts = bounds[:-1][counts > 0]
    fresh[starts] = True
    return hashed[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]
