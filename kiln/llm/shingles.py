"""Word-shingle sets of whole texts as 64-bit hashes, one Arrow batch at a time.

Texts are read as UTF-8 bytes: A-Z are lower-cased, words are the runs of
bytes other than 0x20 and 0x09-0x0D.  A word is hashed from all its bytes, a
shingle from the hashes of its words in order.  A text of fewer words than
the shingle width gives one shingle, the whole sequence; a text without
words (or null) gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240917)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
#: Words are hashed in blocks of so many bytes.  A block adds one random number
#: for each place and byte, and is mixed with its place in the word: unlike a
#: polynomial modulo 2^64 this has no strings that always collide.
_BLOCK_BITS = 6
BLOCK = 1 << _BLOCK_BITS
_TABLE = np.random.default_rng(20261203).integers(0, 2**64, BLOCK << 8, dtype=np.uint64)
#: Bytes of text handled at a time; a longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers (xor-shift and odd multiplier, twice)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes;
    null counts as empty."""
    col = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if len(col) and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(col):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a chunk and, for each row, where its words begin."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    inside = ~_SPACE[low]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[:-1] &= ~inside[1:] | edge[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    length = last - first + 1
    # a word's bytes are consecutive among the bytes inside words
    low = low[inside].astype(np.int32)
    begin_at = np.concatenate(([0], np.cumsum(length)[:-1]))
    place = np.arange(len(low)) - np.repeat(begin_at, length)
    inner = place & (BLOCK - 1)
    begins = np.flatnonzero(inner == 0)
    blocks = mix(np.add.reduceat(_TABLE[inner << 8 | low], begins) + (place[begins] >> _BLOCK_BITS).astype(np.uint64) * _BASE)
    hashes = blocks if len(begins) == len(first) else np.add.reduceat(blocks, np.searchsorted(begins, begin_at))
    return mix(hashes + length.astype(np.uint64) * _BASE), np.searchsorted(first, offsets)


def sets_of(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) by chunks."""
    for row, data, offsets in byte_chunks(texts):
        words, at = words_of(data, offsets)
        yield row, [_shingles(words[a:b], width) for a, b in zip(at[:-1], at[1:])]


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words)
    if not n:
        return words
    k = min(width, n)
    total = words[:n - k + 1] * _PLACE[0]
    for j in range(1, k):
        total += words[j:n - k + 1 + j] * _PLACE[j]
    total = np.sort(mix(total + np.uint64(k)))
    keep = np.ones(len(total), dtype=bool)
    np.not_equal(total[1:], total[:-1], out=keep[1:])
    return total[keep]
