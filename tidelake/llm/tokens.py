"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A-Z count as lower case. A word is a run of bytes of one class; bytes from 0x80 up belong to words, so UTF-8 sequences
are never cut. The hash of a word is a polynomial over random 64-bit values of its bytes,
taken from running sums, so no Python object is made per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_class(*excluded: tuple[int, int]) -> np.ndarray:
    out = np.ones(256, bool)
    for low, high in excluded:
        out[low : high + 1] = False
    return out


#: Everything but ASCII white space.
SPACED = _byte_class((0x09, 0x0D), (0x20, 0x20))
#: ASCII letters and digits, and all beyond ASCII.
LETTERS = _byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: A-Z in lower case.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
_VALUE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_powers: list[np.ndarray] = []
#: Bytes whose running sums are held at once.
_BLOCK = 1 << 20


def _power_arrays(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n, kept in the process."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _BLOCK // 4)
        up, down = np.full(size, _BASE, _U), np.full(size, _INVERSE, _U)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n], _powers[1][:n]


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes; runs are in order and don't overlap. Running sums are
    taken over some runs at a time, so that a long text needs no more memory than a block."""
    out = np.empty(len(start), _U)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + _BLOCK, "right")))
        low, high = int(start[a]), int(end[b - 1])
        up, down = _power_arrays(high - low)
        sums = np.empty(high - low + 1, _U)
        sums[0] = 0
        np.cumsum(_VALUE[data[low:high]] * up, out=sums[1:])
        out[a:b] = (sums[end[a:b] - low] - sums[start[a:b] - low]) * down[start[a:b] - low]
        a = b
    return mix(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


@dataclass
class Words:
    """hash, text (row number), start and end (bytes in data) of each word, in text order."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text, its first word; one more entry closes the last
    data: np.ndarray
    offsets: np.ndarray  # of each text in data

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(raw) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(column: pa.Array, kind: np.ndarray = SPACED) -> Words:
    data, offsets = text_bytes(column)
    n, texts = len(data), len(offsets) - 1
    folded = FOLD[data]
    inside = kind[folded]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][offsets[:-1] < n]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = run_hashes(folded, start, end)
    text = np.searchsorted(offsets, start, "right") - 1
    return Words(hashes, text, start, end, np.searchsorted(text, np.arange(texts + 1)), data, offsets)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row within one text, and the number of the first word of each."""
    at = np.arange(max(0, len(w.hash) - n + 1))
    at = at[w.text[at] == w.text[at + n - 1]]
    out = np.zeros(len(at), _U)
    for i in range(n):
        out = out * _U(_BASE) + w.hash[at + i]
    return mix(out), at
