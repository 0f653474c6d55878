"""Vectorised word scanning over Arrow string columns (runs inside tasks).

A block is a run of whole rows of one Arrow batch, seen as one byte buffer
with row offsets.  Words are maximal runs of bytes marked in a 256-entry
table and never cross a row.  Each word gets a 64-bit polynomial hash of its
bytes, so callers compare words as integers and confirm on bytes where a
decision depends on it.

Nulls read as empty texts.  Memory is bounded by the block: rows are grouped
up to ``BLOCK_BYTES``; a longer row forms a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_MASK = (1 << 64) - 1

#: Word bytes of the two word definitions (a byte >= 0x80 belongs to a word).
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True

#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (length rows + 1) of a string column."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:] \
        if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive (first row, end row) ranges of at most ``limit`` bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES):
    """(first row, bytes, offsets) of each block of a string column."""
    data, offsets = utf8_buffer(column)
    for lo, hi in row_blocks(offsets, limit):
        yield lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


CACHED_POWERS = 1 << 20         # powers that a worker keeps of a base; longer blocks make their own
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base and of its inverse."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < size:
        up, down = np.full(size, np.uint64(base)), np.full(size, np.uint64(pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        known = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size <= CACHED_POWERS:
            _POWERS[base] = known
    return known


def prefix_sums(data: np.ndarray, base: np.uint64 = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial prefix sums and the inverse powers that normalise a slice of them (``base`` is odd)."""
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = _powers(size if size <= CACHED_POWERS else len(data) + 1, int(base))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums, down


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of every bit (high and low) of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one integer, zeros behind the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def same_bytes(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray,
               b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether each range of ``a`` holds the same bytes as the range of ``b`` beside it."""
    size = a_end - a_start
    same = size == b_end - b_start
    left, right = eights(a), eights(b)
    at, done = np.flatnonzero(same), 0
    while len(at):
        rest = size[at] - done
        drop = (np.uint64(8) * (8 - np.minimum(rest, 8)).astype(np.uint64))
        x, y = left[a_start[at] + np.minimum(done, size[at])], right[b_start[at] + np.minimum(done, size[at])]
        differ = ((x ^ y) << np.minimum(drop, np.uint64(63)) != 0) & (rest > 0)
        same[at[differ]] = False
        done += 8
        at = at[~differ & (rest > 8)]
    return same


class Words:
    """Words of a block: byte ranges ``start``/``end``, ``bounds`` (row r owns
    words bounds[r]:bounds[r + 1]) and, on request, ``hashes()``.  ``cuts`` marks
    bytes inside words at which another word begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, cuts: np.ndarray | None = None):
        self.data, self.offsets = data, offsets
        keep = table[data]
        before = np.empty(len(data), dtype=bool)
        if len(data):
            before[0] = False
            before[1:] = keep[:-1]
        first = offsets[:-1][offsets[:-1] < len(data)]
        begins = keep & ~before
        begins[first] = keep[first]
        stops = np.zeros(len(data) + 1, dtype=bool)
        stops[:-1] = before & ~keep
        stops[first] = before[first] if len(first) else False
        if len(data):
            stops[len(data)] = keep[-1]
        if cuts is not None:
            begins |= cuts
            stops[:-1] |= cuts
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops)
        self.bounds = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())

    def hashes(self, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        sums, down = prefix_sums(self.data)
        start, end = self.start[some], self.end[some]
        h = (sums[end] - sums[start]) * down[start]
        return mix(h + (end - start).astype(np.uint64) * _BASE)

    def joined(self) -> tuple[bytes, np.ndarray]:
        """The words separated by single spaces, and each word's start in that buffer."""
        size = self.end - self.start
        begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1] if len(size) else np.zeros(0, dtype=np.int64)
        total = int(size.sum() + len(size))
        out = np.full(total, 0x20, dtype=np.uint8)
        if total:
            source = np.repeat(self.start - begin, size)
            target = np.ones(total, dtype=bool)
            target[begin + size] = False
            at = np.flatnonzero(target)
            out[at] = self.data[at + source]
        return out.tobytes(), begin


def word_hash(word: str | bytes) -> np.uint64:
    """The hash that ``Words.hashes`` gives this word."""
    raw = word.encode() if isinstance(word, str) else word
    data = np.frombuffer(raw, dtype=np.uint8)
    return Words(data, np.array([0, len(data)]), np.ones(256, dtype=bool)).hashes()[0]


def word_texts(text: str | None, table: np.ndarray, lower: bool = True) -> list[bytes]:
    """Words of one small text, by the same definition as ``Words``."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    data = LOWER[data] if lower else data
    w = Words(data, np.array([0, len(data)]), table)
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(w.start.tolist(), w.end.tolist())]
