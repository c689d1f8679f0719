"""Vectorised text features over Arrow string columns (numpy, no per-word Python).

Texts are handled as the UTF-8 bytes of a whole batch slice.  A word hash is a
difference of prefix sums of a polynomial in the bytes (mod 2**64), so all words of
a slice are hashed in a few array passes; shingle hashes combine the hashes of
neighbouring words.  Slices hold about ``SLICE_BYTES`` bytes, so memory is bounded
by that or by one very long text.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_RADIX = 0x9E3779B97F4A7C15  # odd, so it has an inverse mod 2**64
_INVERSE = pow(_RADIX, -1, 1 << 64)
_SALTS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
          0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_RADIX))

#: Kind of each byte: a word is a run of bytes of one kind other than 0.
WORD = np.ones(256, dtype=np.uint8)
WORD[[0x20, *range(0x09, 0x0E)]] = 0
#: As WORD, but punctuation and symbols make words of their own (kind 2).
PUNCT = WORD.copy()
PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 2
#: As WORD, with punctuation and symbols between words as well.
PLAIN = np.where(PUNCT == 2, 0, PUNCT).astype(np.uint8)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict = {}


def _powers(n: int):
    if _POWERS.get("n", 0) < n:
        n = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        _POWERS.update(n=n, up=powers(_RADIX, n), down=powers(_INVERSE, n))
    return _POWERS["up"], _POWERS["down"]


def give_back():
    """Return memory that this process has freed to the system.  Python workers live on between tasks, and what their
    allocators keep adds up on an executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(column, limit: int = SLICE_BYTES):
    """Yield (first row, bytes, offsets) over a string column; null counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * column.offset)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last
    del column, at, raw, data
    give_back()


class Words:
    """The words of a slice: runs of bytes of one ``kind``, split at text borders.

    ``start``/``end``: byte positions; ``doc``: index of the text in the slice;
    ``hash``: 64-bit word hashes; ``count``/``first``: words of, and before, each text.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = True, kind: np.ndarray = WORD):
        self.n = len(at) - 1
        if lower:
            data = LOWER[data]
        self.data, self.at = data, at
        size = len(data)
        of = kind[data]
        border = np.zeros(size + 1, dtype=bool)
        border[at] = True
        cut = (of[1:] != of[:-1]) | border[1:size]
        begin, stop = of > 0, of > 0
        begin[1:] &= cut
        stop[:-1] &= cut
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.doc = np.searchsorted(at, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=self.n)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        up, down = _powers(size + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[:size], out=total[1:])
        self._total, self._down = total, down
        length = (self.end - self.start).astype(np.uint64)
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + length)

    def prefix_hash(self, which: np.ndarray, k: int) -> np.ndarray:
        """Hash of the first ``k`` bytes of the given words."""
        start = self.start[which]
        return (self._total[start + k] - self._total[start]) * self._down[start]

    def shingles(self, n: int, short: bool = True):
        """(hash, text index) of every ``n``-word shingle in text order; with ``short``, a text of
        fewer words gives its whole sequence as one shingle."""
        words = self.hash
        k = len(words)
        if k >= n:
            ok = self.doc[:k - n + 1] == self.doc[n - 1:]
            h = np.zeros(k - n + 1, dtype=np.uint64)
            for j in range(n):
                h += words[j:k - n + 1 + j] * np.uint64(_SALTS[j])
            where = np.flatnonzero(ok)
            h, doc = mix(h[where] + np.uint64(n)), self.doc[where]
        else:
            where = np.zeros(0, dtype=np.int64)
            h, doc = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        if short:
            few = np.flatnonzero((self.count > 0) & (self.count < n))
            if len(few):
                m, at = self.count[few], self.first[few]
                s = np.zeros(len(few), dtype=np.uint64)
                for j in range(n - 1):
                    has = m > j
                    s[has] += words[at[has] + j] * np.uint64(_SALTS[j])
                s = mix(s + m.astype(np.uint64))
                order = np.argsort(np.concatenate((doc, few)), kind="stable")
                h, doc = np.concatenate((h, s))[order], np.concatenate((doc, few))[order]
        return h, doc


def per_text(values: np.ndarray, doc: np.ndarray, n: int):
    """Split ``values``, ordered by text index ``doc``, into one array per text."""
    return np.split(values, np.cumsum(np.bincount(doc, minlength=n))[:-1])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
