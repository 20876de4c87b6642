"""Vectorised byte-level kernels shared by the text operators.

Every function works on whole Arrow string columns at once: the UTF-8 buffer is viewed as a
``uint8`` array, word boundaries are found with a 256-entry class table, and words are hashed to
64 bits (and by a second hash, where hashes alone decide) by a segmented sum of mixed bytes.  Every place of
a word has its own pseudo-random factor and every product is folded before it is added, so no algebra
of the places (as of powers of one number) makes unequal words equal.  No Python object is made per word.  ASCII separators never
occur inside a multi-byte UTF-8 sequence, so splitting bytes equals splitting code points.

Null texts are treated as empty: they have no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15 | 1)
_WORD_STEP = _U(0xD6E8FEB86659FD93)

#: bytes that separate words when words are runs of non-blank characters
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: bytes that separate words when words are runs of ASCII letters, digits and non-ASCII characters
NON_WORD = np.zeros(256, bool)
NON_WORD[0x00:0x30] = True
NON_WORD[0x3A:0x61] = True
NON_WORD[0x7B:0x80] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: texts of one batch are handled in slices of about this many bytes, which bounds memory
SLICE_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Factors:
    """Odd pseudo-random factors by place, as many as the longest word so far needs."""

    def __init__(self, salt: int):
        self.salt, self.values = _U(salt), np.zeros(0, _U)
        self(256)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            size = max(n, 2 * len(self.values))
            self.values = mix64(np.arange(1, size + 1, dtype=_U) * _MULT + self.salt) | _U(1)
        return self.values


_FACTORS = (_Factors(0x243F6A8885A308D3), _Factors(0x13198A2E03707344))


def _segment_sums(raw: np.ndarray, place: np.ndarray, bounds: np.ndarray, longest: int, which: int) -> np.ndarray:
    """Sums of folded products of the bytes ``raw`` at ``place`` over the segments that start at ``bounds``."""
    value = (raw.astype(_U) + _U(1)) * _FACTORS[which](longest)[place]
    value ^= value >> _U(29)
    return np.add.reduceat(value, bounds)


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES):
    """Yield ``(first_row, n_rows, bytes, offsets)`` slices of a string column, nulls as empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    at = 0
    for c in chunks:
        if len(c) == 0:
            continue
        c = c.cast(pa.large_string())
        if c.null_count:
            c = c.fill_null("")
        buffers = c.buffers()
        off = np.frombuffer(buffers[1], np.int64, len(c) + 1 + c.offset)[c.offset :]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(c):
            j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
            j = min(max(j, i + 1), len(c))
            yield at + i, j - i, data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j
        at += len(c)


class Words:
    """The words of several texts: ``start``/``end`` byte positions, ``row`` of each word,
    ``first`` (index of each row's first word, with one entry more at the end) and ``hash``; ``second``
    makes another hash of given runs of words, independent of the first."""

    __slots__ = ("data", "start", "end", "row", "first", "hash")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool):
        if lower:
            data = _LOWER[data]
        self.data = data
        n_rows = len(offsets) - 1
        inside = ~separators[data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        edges = offsets[:-1][np.diff(offsets) > 0]
        before[edges] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edges[1:] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(n_rows), np.diff(self.first))
        self.hash = self._hashed(0, self.start, self.end - self.start, np.flatnonzero(inside))

    def _hashed(self, which: int, start: np.ndarray, length: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        if not len(start):
            return np.zeros(0, _U)
        bounds = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(bounds, length)
        if at is None:
            at = place + np.repeat(start, length)
        total = _segment_sums(self.data[at], place, bounds, int(length.max()), which)
        return mix64(total + length.astype(_U) * _WORD_STEP)

    def second(self, at: np.ndarray, k: int) -> np.ndarray:
        """32 bits of another hash of the runs of ``k`` words that start at ``at``."""
        needed = covered(at, k, len(self.start))
        word = np.zeros(len(self.start), _U)
        word[needed] = self._hashed(1, self.start[needed], (self.end - self.start)[needed])
        total = np.zeros(len(at), _U)
        for d, factor in enumerate(_FACTORS[1](k)[:k]):
            total += word[at + d] * factor
        return (mix64(total) >> _U(32)).astype(np.uint32)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values; entry i covers i..i+k-1 (only the first
    ``len(h)-k+1`` entries exist).  Runs that cross a row must be masked by the caller."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out, have = None, 0
    power, size = h, 1
    while True:
        if k & size:
            part = power[have : have + n]
            out = part.copy() if out is None else mix64(out * _MULT + part)
            have += size
        if have == k:
            return out if k > 1 else mix64(out + _WORD_STEP)
        power = mix64(power[: len(power) - size] * _WORD_STEP + (power[size:] ^ (power[size:] >> _U(29))))
        size *= 2


def window_rows(words: Words, k: int) -> np.ndarray:
    """Mask over window starts: True where the ``k`` words lie in one row."""
    n = len(words.start) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    return words.row[:n] == words.row[k - 1 :]


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Mask of the n positions that lie in a window of k starting at one of ``starts``."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + k, n), -1)
    return np.cumsum(d[:-1]) > 0


def segment_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the byte ranges ``start..end`` (which may be empty)."""
    n = len(start)
    length = (end - start).astype(np.int64)
    filled = np.flatnonzero(length > 0)
    bounds = np.cumsum(length[filled]) - length[filled]
    place = np.arange(int(length.sum())) - np.repeat(bounds, length[filled])
    raw = data[place + np.repeat(start[filled], length[filled])]
    out = []
    for which in (0, 1):
        total = np.zeros(n, _U)
        if len(filled):
            total[filled] = _segment_sums(raw, place, bounds, int(length.max()), which)
        out.append(mix64(total + length.astype(_U) * _MULT + _U(which)))
    return out[0], out[1]


#: a slice for ``gram_slices`` must have fewer bytes than this
GRAM_LIMIT = 1 << 23


class Grams:
    """The byte grams of one slice, sorted and distinct.

    Every byte of every text ends one gram of ``order`` bytes; positions before the start of a text
    count as byte 0.  ``distinct`` are the packed grams, ``which`` gives for each byte (in text
    order) the index of its gram."""

    __slots__ = ("distinct", "which", "counts")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, order: int = 5, inverse: bool = True):
        n = len(data)
        packed = np.zeros(n, _U)
        lengths = np.diff(offsets)
        place = np.arange(n) - np.repeat(offsets[:-1], lengths)
        wide = data.astype(_U)
        packed |= wide
        for k in range(1, order):
            part = np.zeros(n, _U)
            part[k:] = wide[:-k] if n > k else wide[:0]
            part[place < k] = 0
            packed |= part << _U(8 * k)
        if not inverse:
            packed.sort()
            new = np.ones(n, bool)
            new[1:] = packed[1:] != packed[:-1]
            at = np.flatnonzero(new)
            self.distinct, self.counts, self.which = packed[at], np.diff(np.append(at, n)), None
            return
        keyed = (packed << _U(23)) | np.arange(n, dtype=_U)
        keyed.sort()
        grams, where = keyed >> _U(23), (keyed & _U(GRAM_LIMIT - 1)).astype(np.int64)
        new = np.ones(n, bool)
        new[1:] = grams[1:] != grams[:-1]
        at = np.flatnonzero(new)
        self.distinct, self.counts = grams[at], np.diff(np.append(at, n))
        self.which = np.empty(n, np.int32)
        self.which[where] = (np.cumsum(new) - 1).astype(np.int32)


def gram_slices(column, limit: int = 4 << 20):
    """Like ``text_slices`` but never yields more than ``GRAM_LIMIT`` bytes: a longer text comes in
    several parts, ``(row, n_rows, bytes, offsets, context)``, where ``context`` bytes at the front
    of a part repeat the end of the part before and are not to be counted."""
    for row, n, data, offsets in text_slices(column, limit):
        if len(data) < GRAM_LIMIT:
            yield row, n, data, offsets, 0
            continue
        step = GRAM_LIMIT // 2
        for a in range(0, len(data), step):
            context = min(8, a)
            part = data[a - context : a + step]
            yield row, 1, part, np.array([0, len(part)], np.int64), context
