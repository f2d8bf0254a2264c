"""Suffix-array dedup (operator 9): remove every byte of a repeated 100-byte string.

The last step of `repeats` resolves, per partition, the strings that may start
earlier. Here that is a longest-previous-factor (LPF) array: suffixes are put in
order, and for every position the nearest *smaller* text positions before and
behind it in suffix order (previous / next smaller values) are the only places
that can hold its longest earlier match. A byte string of `window` bytes is a
later copy where one of the two shares its first `window` bytes, so the LPF
array is kept truncated at that length: it is `window` or "shorter".

Defined results: null or empty text has 0 bytes and nothing removed; rows with a
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
from ripplecast.llm.suffixes import ranks, window_starts, with_sentinels
from ripplecast.llm.tables import read
from ripplecast.llm.text import Chunk, byte_symbols, chunks

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def previous_smaller(a: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each element, -1 if none.

    Pointer jumping: everything between j and p[j] is larger than a[j], so a
    pointer that lands on a larger value may follow that value's own pointer.
    """
    p = np.arange(-1, len(a) - 1)
    active = np.arange(len(a))
    while len(active):
        q = p[active]
        active = active[(q >= 0) & (a[np.maximum(q, 0)] > a[active])]
        p[active] = p[p[active]]
    return p


def next_smaller(a: np.ndarray) -> np.ndarray:
    back = previous_smaller(a[::-1])[::-1]
    return np.where(back < 0, -1, len(a) - 1 - back)


def longest_previous_factors(values: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """LPF at every symbol, truncated: `window` where the window occurs earlier, else 0."""
    text, at = with_sentinels(values, starts)
    rank = ranks(text, window, 9)[at]
    place = window_starts(starts, counts)
    order = place[np.lexsort((place, rank[place]))]  # suffix order of the window starts
    lpf = np.zeros(len(values), np.int64)
    for smaller in (previous_smaller(order), next_smaller(order)):
        has = smaller >= 0
        here, there = order[has], order[smaller[has]]
        lpf[here[rank[here] == rank[there]]] = window
    return lpf


def _symbols(c: Chunk) -> Symbols:
    return Symbols(c.buf, byte_symbols(c.buf), c.starts, c.ends)


def _index(values, starts, counts, window):
    return longest_previous_factors(values, starts, counts, window) >= window


def scheme(window: int) -> Scheme:
    return Scheme(window, max(1, window // 3), _symbols, "<u1", _index)


def _digest(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            gone = removed_mask(c, c.starts, c.ends)
            n_removed, n_spans, sha, kept = [], [], [], []
            for a, b in zip(c.starts, c.ends, strict=True):
                mask = gone[a:b]
                n = int(np.count_nonzero(mask))
                rest = c.buf[a:b] if not n else c.buf[a:b][~mask]
                n_removed.append(n)
                n_spans.append(int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if n else 0)
                sha.append(hashlib.sha256(rest.tobytes()).hexdigest())
                kept.append(rest.tobytes() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    c.table.column("doc_id"), pa.array(c.ends - c.starts, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def suffix_dedup(
    docs: DataFrame, window: int = 100, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """Per document: sizes, removed runs, digest and (with `keep_text`) the remaining bytes."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans = removed_spans(docs, scheme(window), "lpf")
    return with_spans(docs, spans).mapInArrow(_digest(keep_text), SCHEMA)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents"), keep_text=False).drop("kept")
