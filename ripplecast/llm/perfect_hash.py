"""A minimal perfect hash over distinct 128-bit keys, built and probed with numpy.

Level by level every key picks a place in a bit array of twice the number of keys
left. Keys alone at their place set its bit, the others go on to the next level. A
key's slot is the number of set bits before its own: the slots of n keys are
exactly 0 .. n - 1, at about four bits a key. A foreign key lands in some slot or
in none; the caller tells it apart by a fingerprint stored in the slot.
"""

from __future__ import annotations

import numpy as np

from ripplecast.llm.text import mix

#: Places of a level for each key that is left.
ROOM = 2


def _place(h1: np.ndarray, h2: np.ndarray, level: int, places: int) -> np.ndarray:
    x = mix(h1 ^ mix(h2, 2 * level + 1), 2 * level + 2)
    return ((x >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)


class MinimalHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # 64-bit words; a level has 64 * len(words) places
        self.before, base = [], 0
        for words in levels:
            ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.before.append(base + np.append(0, ones[:-1]))
            base += int(ones[-1])
        self.size = base

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> MinimalHash:
        """Over distinct keys (h1, h2)."""
        levels = []
        while len(h1):
            places = -(-ROOM * len(h1) // 64) * 64
            at = _place(h1, h2, len(levels), places)
            alone = np.bincount(at, minlength=places) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        return cls(levels)

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level holds it."""
        out = np.full(len(h1), -1, np.int64)
        live = np.arange(len(h1))
        for level, (words, before) in enumerate(zip(self.levels, self.before, strict=True)):
            at = _place(h1[live], h2[live], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            low = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[live[hit]] = (before[at >> 6] + np.bitwise_count(low))[hit]
            live = live[~hit]
            if not len(live):
                break
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return sizes.tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def load(cls, body, start: int) -> tuple[MinimalHash, int]:
        """From the bytes at `start`; also the place behind it."""
        count = int(np.frombuffer(body, "<i8", 1, start)[0])
        sizes = np.frombuffer(body, "<i8", count, start + 8).tolist()
        start += 8 * (count + 1)
        levels = []
        for n in sizes:
            levels.append(np.frombuffer(body, "<u8", n, start))
            start += 8 * n
        return cls(levels), start
