"""Substring dedup (operator 5): remove every word of a repeated 20-word window.

The last step of `repeats` resolves, per partition (shard), the windows that may
start earlier. Here each shard gets an FM-index: the Burrows-Wheeler transform of
its word sequence in a wavelet matrix of packed bits with popcount ranks. The
shard's documents are streamed against it: a backward search from the end of
each window gives its matching statistic (the longest match ending there), and
windows whose statistic reaches the threshold at an earlier position are reported.

Defined results: null or empty text has 0 words and nothing removed; rows with a
null doc_id are returned unchanged and match nothing; rows repeating a doc_id
are one document; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.repeats import Scheme, Symbols, removed_mask, removed_spans, with_spans
from ripplecast.llm.suffixes import dense, ranks, window_starts, with_sentinels
from ripplecast.llm.tables import read
from ripplecast.llm.text import Chunk, chunks, split_words, word_hashes

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


class Bits:
    """A bit sequence in 64-bit words with a running count per word."""

    def __init__(self, bits: np.ndarray):
        pad = -len(bits) % 64
        packed = np.packbits(np.append(bits, np.zeros(pad + 64, bool)), bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1])
        self.zeros = len(bits) - int(np.count_nonzero(bits))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before place i."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class FMIndex:
    """FM-index over `text` (dense symbols, 0 ends a row) for patterns of up to `depth` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        sigma = int(text.max()) + 1 if len(text) else 1
        self.width = max(1, (sigma - 1).bit_length())
        # Rows ordered by their first `depth` symbols suffice for patterns no longer than that.
        self.places = np.argsort(ranks(text, depth, self.width), kind="stable")
        bwt = text[self.places - 1]  # place 0 wraps to the last symbol, a row end
        self.levels = []
        for level in range(self.width - 1, -1, -1):
            bit = (bwt >> level & 1).astype(bool)
            self.levels.append(Bits(bit))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        symbols = np.arange(sigma)
        count = np.bincount(text, minlength=sigma)
        # Rows before those of a symbol, less the start of its block in the last level.
        self.base = np.cumsum(count) - count - self._descend(symbols, np.zeros(sigma, np.int64))
        self._minima = [self.places]

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits in enumerate(self.levels):
            one = bits.ones(i)
            i = np.where(symbol >> (self.width - 1 - k) & 1, bits.zeros + one, i - one)
        return i

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of symbol + pattern from the rows [lo, hi) of a pattern."""
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.base[symbol]
        return both[: len(lo)] + base, both[len(lo) :] + base

    def earliest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least text place among rows [lo, hi), by doubling minima."""
        out = np.empty(len(lo), np.int64)
        level = np.frompyfunc(int.bit_length, 1, 1)(hi - lo).astype(np.int64) - 1
        for k in np.unique(level):
            while len(self._minima) <= k:
                last, half = self._minima[-1], 1 << (len(self._minima) - 1)
                self._minima.append(np.minimum(last[:-half], last[half:]))
            at = level == k
            out[at] = np.minimum(self._minima[k][lo[at]], self._minima[k][hi[at] - (1 << int(k))])
        return out


def matching_statistics(
    index: FMIndex, text: np.ndarray, begin: np.ndarray, count: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Stream rows against the index; windows that occur at an earlier place.

    Row r is a lane whose windows start at begin[r] .. begin[r] + count[r] - 1. A
    search that has only its own row left after reading text[q:e] shows that
    no window holding text[q:e] repeats: the lane goes on behind q.
    """
    hits = []
    lane, at, stop = np.arange(len(begin)), begin.copy(), begin + count
    while len(lane):
        lo, hi = np.zeros(len(lane), np.int64), np.full(len(lane), len(text), np.int64)
        fail = np.full(len(lane), -1, np.int64)
        live = np.arange(len(lane))
        for k in range(window - 1, -1, -1):
            lo[live], hi[live] = index.extend(text[at[live] + k], lo[live], hi[live])
            alone = hi[live] - lo[live] <= 1
            fail[live[alone]] = k
            live = live[~alone]
            if not len(live):
                break
        found = live[index.earliest(lo[live], hi[live]) < at[live]] if len(live) else live
        hits.append(at[found])
        at += np.maximum(fail, 0) + 1
        go = at < stop[lane]
        lane, at = lane[go], at[go]
    return np.concatenate(hits) if hits else np.zeros(0, np.int64)


def _symbols(c: Chunk) -> Symbols:
    words = split_words(c.buf, c.starts, c.ends)
    hashed = word_hashes(c.buf, words)
    return Symbols(hashed, hashed, words.first, words.last)


def _index(values, starts, counts, window):
    text, at = with_sentinels(dense(values), starts)
    hit = np.zeros(len(text), bool)
    hit[matching_statistics(FMIndex(text, window), text, at[starts], counts, window)] = True
    return hit[at]


def scheme(window: int) -> Scheme:
    return Scheme(window, max(1, window // 3), _symbols, "<u8", _index)


def _digest(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            words = split_words(c.buf, c.starts, c.ends)
            keep = ~removed_mask(c, words.first, words.last)
            row = words.row()
            kept = np.bincount(row[keep], minlength=len(c.ids))
            # Each kept word but a row's last one takes the separator behind it, as a space.
            after = np.append(np.cumsum(keep), 0)
            more = keep & (after[:-1] < np.cumsum(kept)[row])
            delta = np.zeros(len(c.buf) + 2, np.int32)
            np.add.at(delta, words.start[keep], 1)
            np.add.at(delta, (words.end + more)[keep], -1)
            mask = np.cumsum(delta)[: len(c.buf)] > 0
            buf = c.buf.copy()
            buf[words.end[more]] = 0x20
            out = buf[mask]
            size = np.append(0, np.cumsum(mask))
            cut = [out[size[a] : size[b]].tobytes() for a, b in zip(c.starts, c.ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    c.table.column("doc_id"), pa.array(words.count, pa.int64()),
                    pa.array(words.count - kept, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in cut], pa.string()),
                    pa.array([x.decode() if keep_text else None for x in cut], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def substring_dedup(
    docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """Per document: words, removed words, digest and (with `keep_text`) the kept words."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans = removed_spans(docs, scheme(window), "fm")
    return with_spans(docs, spans).mapInArrow(_digest(keep_text), SCHEMA)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents"), keep_text=False).drop("kept")
