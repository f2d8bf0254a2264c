"""Vectorised text primitives over Arrow string buffers.

Everything here works on one *chunk*: a few megabytes of consecutive rows whose
texts lie end to end in one byte buffer. No Python object is made per word.
Null texts count as empty; rows with a null id keep `valid` False.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
#: Rows of a chunk fit in the bits above a 50-bit shingle, so one plain sort orders both.
CHUNK_ROWS = 1 << 14
SHINGLE_BITS = 50

#: Word separators of every contract: space and \\t \\n \\v \\f \\r.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUATION = np.zeros(256, bool)
CONTINUATION[0x80:0xC0] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the rolling base modulo 2**64, and of its inverse."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            globals()[name] = np.multiply.accumulate(x)
    return _powers[:n], _inverses[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & (2**64 - 1))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


_BYTE = mix(np.arange(256, dtype=np.uint64), 11)


@dataclass
class Chunk:
    ids: np.ndarray  # int64, 0 where the id is null
    valid: np.ndarray  # id is not null
    buf: np.ndarray  # uint8, the texts end to end
    starts: np.ndarray  # int64 per row, into buf
    ends: np.ndarray
    table: pa.RecordBatch  # the rows themselves, for further columns

    def rows(self, at: np.ndarray) -> Chunk:
        """Some of the rows as a chunk of their own."""
        size = (self.ends - self.starts)[at]
        ends = np.cumsum(size)
        take = np.arange(int(size.sum())) - np.repeat(ends - size, size) + np.repeat(self.starts[at], size)
        return Chunk(self.ids[at], self.valid[at], self.buf[take], ends - size, ends, self.table.take(pa.array(at)))


def _string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offs


def chunks(
    batches: Iterator[pa.RecordBatch], id_col: str | None = "doc_id", text_col: str = "text", size: int = CHUNK_BYTES
) -> Iterator[Chunk]:
    """Cut record batches into chunks of about `size` text bytes (one long text may exceed it)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offs = _string_buffers(batch.column(text_col).cast(pa.large_string()))
        if id_col is None:
            ids, valid = np.arange(batch.num_rows, dtype=np.int64), np.ones(batch.num_rows, bool)
        else:
            col = batch.column(id_col)
            valid = np.asarray(col.is_valid())
            ids = col.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
        row, n = 0, batch.num_rows
        while row < n:
            last = max(row + 1, int(np.searchsorted(offs, offs[row] + size, "right")) - 1)
            last = min(last, row + CHUNK_ROWS)
            lo, hi = offs[row], offs[last]
            yield Chunk(
                ids[row:last], valid[row:last], data[lo:hi], offs[row:last] - lo, offs[row + 1 : last + 1] - lo,
                batch.slice(row, last - row),
            )
            row = last


@dataclass
class Words:
    start: np.ndarray  # byte offset of every word
    end: np.ndarray
    first: np.ndarray  # per row: its words are first[i]:last[i]
    last: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return self.last - self.first

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), self.count)


def split_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Words:
    """Maximal runs of non-separator bytes inside each row."""
    inside = ~SEPARATOR[buf]
    n = len(buf)
    full = ends > starts
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        before[starts[full]] = False
        after[ends[full] - 1] = False
    begin = np.flatnonzero(inside & ~before)
    return Words(
        begin, np.flatnonzero(inside & ~after) + 1, np.searchsorted(begin, starts), np.searchsorted(begin, ends)
    )


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: the hash of symbols[a:b] is (S[b]-S[a]) * inverse**a."""
    out = np.empty(len(symbols) + 1, np.uint64)
    out[0] = 0
    np.cumsum(symbols * powers(len(symbols))[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (sums[b] - sums[a]) * powers(len(sums))[1][a]


def gram_hash(sums: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive symbols."""
    n = len(sums) - k
    return (sums[k:] - sums[:-k]) * powers(len(sums))[1][:n] if n > 0 else np.zeros(0, np.uint64)


def byte_symbols(buf: np.ndarray) -> np.ndarray:
    return _BYTE[buf]


def word_hashes(buf: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    sums = prefix_sums(byte_symbols(buf))
    return mix(span_hash(sums, words.start, words.end) ^ (words.end - words.start).astype(np.uint64))


def shingle_sets(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of every row over A-Z lower-cased words.

    Returns (row, 50-bit hash) sorted by row then hash. A row with fewer than k words
    has its whole sequence as one shingle; one without words has none.
    """
    buf = LOWER[buf]
    words = split_words(buf, starts, ends)
    sums = prefix_sums(word_hashes(buf, words))
    grams = mix(gram_hash(sums, k), 5)
    count = np.maximum(words.count - k + 1, 0)
    row = np.repeat(np.arange(len(starts)), count)
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(words.first, count)
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    value = np.concatenate([grams[at], mix(span_hash(sums, words.first[short], words.last[short]), 6)])
    row = np.concatenate([row, short])
    packed = np.sort((row.astype(np.uint64) << np.uint64(SHINGLE_BITS)) | (value >> np.uint64(64 - SHINGLE_BITS)))
    if len(packed):
        packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]
    return (packed >> np.uint64(SHINGLE_BITS)).astype(np.int64), packed & np.uint64((1 << SHINGLE_BITS) - 1)
