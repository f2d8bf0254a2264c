"""Suffix order to a fixed depth, by doubling over ranks."""

from __future__ import annotations

import numpy as np


def dense(keys: np.ndarray) -> np.ndarray:
    """Rank of every key among the distinct keys (int64)."""
    order = np.argsort(keys)
    s = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]])) if len(keys) else 0
    return rank


def shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def ranks(symbols: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Equal ranks: the next `depth` symbols are equal; smaller rank: they sort earlier.

    `symbols` are at least 0 and below 2**bits; beyond the end they count as 0.
    """
    packed = min(depth, max(1, 63 // bits))
    key = symbols.astype(np.int64)
    for j in range(1, packed):
        key = (key << bits) | shifted(symbols, j).astype(np.int64)
    rank, known = dense(key), packed
    while known < depth:
        step = min(known, depth - known)
        rank = dense((rank << 32) | shifted(rank, step))
        known += step
    return rank


def with_sentinels(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols shifted by one with a 0 behind every row, and the place of every value."""
    row = np.searchsorted(starts, np.arange(len(values)), "right") - 1
    at = np.arange(len(values)) + row
    text = np.zeros(len(values) + len(starts), np.int64)
    text[at] = values.astype(np.int64) + 1
    return text, at


def window_starts(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places (among the values) at which a window of its row begins."""
    base = np.cumsum(counts) - counts
    return np.repeat(starts, counts) + np.arange(int(counts.sum())) - np.repeat(base, counts)
