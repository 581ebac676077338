"""Vectorised numpy helpers shared by the text operators; they run on one Arrow batch inside a task.

Words and shingles are found on UTF-8 bytes: every word rule used here is a set of ASCII bytes that separate, so
multi-byte characters never need decoding.  All functions take whole texts and cut batches into slices of
SLICE_BYTES, so memory follows the longest single text and not the batch.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

#: Separator bytes of the two word rules: white space, and everything ASCII but digits and letters.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))
#: Bytes of an 8-byte piece that belong to a span of which 0, 1, ... 8 bytes are left.
_PART = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer spans are digested one by one.
LONG_SPAN = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that sums of products spread over all bits."""
    x = x ^ (x >> _MIX[2])
    x = x * _MIX[0]
    x ^= x >> _MIX[2]
    x *= _MIX[1]
    x ^= x >> _MIX[2]
    return x


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task should not hold its largest batch."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of rows in those bytes); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        end = min(end, len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
    give_back()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] of non-empty spans.

    Pieces of 8 bytes are chained, each mixed before the next one comes, so that no sum of pieces cancels another; spans of
    at most 8 bytes and one length have different hashes for certain.  Spans of over LONG_SPAN bytes take blake2b.
    """
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    pieces = np.ndarray((len(data) + 1,), np.uint64, padded, strides=(1,))
    out = mix(lengths.astype(np.uint64) * _ODD)
    out = mix(out ^ (pieces[starts] & _PART[np.minimum(lengths, 8)]))
    done, go = 8, np.flatnonzero((lengths > 8) & (lengths <= LONG_SPAN))
    while len(go):
        left = lengths[go] - done
        out[go] = mix(out[go] ^ (pieces[starts[go] + done] & _PART[np.minimum(left, 8)]))
        done, go = done + 8, go[left > 8]
    for k in np.flatnonzero(lengths > LONG_SPAN):
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return out


class Words:
    """Words of the rows of one slice: byte bounds, 64-bit hashes, and where each row's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        inside = ~separators[self.data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        cut[-1] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.rows = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def _chained(words: np.ndarray, n: int, size: int) -> np.ndarray:
    """Hashes of the n runs of `size` word hashes; the order of words counts, as every step mixes before it adds."""
    total = words[:n].copy()
    for k in range(1, size):
        total ^= total >> np.uint64(32)
        total *= _ODD
        total += words[k : k + n]
    return mix(total)


def shingles(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word position, 64-bit hash) of every full shingle; rows are word offsets of the texts.

    Two different shingles of two texts of n and m words have one hash with a chance of about n * m / 2^64.
    """
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    valid = np.ones(n, bool)
    ends = rows[1:][rows[1:] > rows[:-1]]
    begins = rows[:-1][rows[1:] > rows[:-1]]
    for back in range(1, size):
        at = ends - back
        valid[at[(at >= begins) & (at < n)]] = False
    at = np.flatnonzero(valid)
    return at, _chained(words, n, size)[at]


def whole(words: np.ndarray) -> np.uint64:
    """Hash of a text of too few words for one shingle; its length keeps it apart from all shingles."""
    return mix(_chained(words, 1, len(words)) ^ np.uint64(len(words)))[0]


def shingle_sets(column: pa.Array, size: int, separators: np.ndarray = WHITE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of every row, in row order; a text of fewer words is one shingle."""
    for first, last, data, offsets in slices(column):
        found = Words(data, offsets, separators)
        hashed = found.hashes()
        at, codes = shingles(hashed, found.rows, size)
        owner = np.searchsorted(at, found.rows)
        for k in range(last - first):
            n = found.rows[k + 1] - found.rows[k]
            if n >= size:
                yield np.unique(codes[owner[k] : owner[k + 1]])
            elif n:
                yield np.array([whole(hashed[found.rows[k] : found.rows[k + 1]])], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


class LineKeys:
    """Lines of the rows of one slice, stripped of white space at both ends, A-Z lower-cased."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, white: np.ndarray):
        self.data, self.offsets = LOWER[data], offsets
        breaks = np.flatnonzero(data == 0x0A)
        # a row's first line, and one line after every break; rows in order, as empty rows share a start
        starts = np.concatenate([offsets[:-1], breaks + 1])
        rows = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets[1:], breaks, "right")])
        order = np.lexsort((starts, rows))
        self.starts, self.row = starts[order], rows[order]
        firsts = np.searchsorted(self.row, np.arange(len(offsets) - 1))
        self.line = np.arange(len(self.row)) - firsts[self.row]
        ends = np.empty(len(self.starts), np.int64)
        ends[:-1] = self.starts[1:] - 1
        ends[-1:] = offsets[-1]
        last = np.flatnonzero(np.r_[self.row[1:] != self.row[:-1], True]) if len(self.row) else np.zeros(0, np.int64)
        ends[last] = offsets[1:][self.row[last]]
        solid = np.flatnonzero(~white[data])
        lo, hi = np.searchsorted(solid, self.starts), np.searchsorted(solid, ends)
        some = hi > lo
        self.begin = np.where(some, solid[np.minimum(lo, max(len(solid) - 1, 0))] if len(solid) else 0, self.starts)
        self.end = np.where(some, solid[np.maximum(hi - 1, 0)] + 1 if len(solid) else 0, self.begin)

    def long_lines(self, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, line number, both halves of a 128-bit digest) of the lines of at least min_chars code points."""
        points = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=points[1:])
        long = np.flatnonzero(points[self.end] - points[self.begin] >= min_chars)
        text = memoryview(self.data)
        digests = [hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(self.begin[long].tolist(), self.end[long].tolist(), strict=True)]
        halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        return self.row[long], self.line[long], halves[:, 0].copy(), halves[:, 1].copy()
