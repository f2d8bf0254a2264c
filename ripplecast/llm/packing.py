"""Best-fit packing (operator 6): token sequences of at most `capacity` ids.

Tokenising: the tokenizer's pre-tokens never cross white space, so ids are
computed once per distinct word of a worker process (a bounded cache) and gathered for every
occurrence. A task holds CHUNK bytes of text or one longer text, at about 60 bytes a word.

Packing works on the histogram of piece lengths, at most `capacity` numbers whatever
the corpus: exact-complement hashing keeps an index of the available single lengths,
of pair sums and (through it) triple sums. From the longest length on, combinations that
fill the gap exactly are consumed as often as their counts allow; what has no exact
complement goes best-fit into the tightest open gap. The plan is a list of patterns
with multiplicities. Pieces get their rank among those of equal length from a range
partitioning, and look their place up in the plan.

Defined results: null or empty text is the end id alone; rows are packed one by
one, also with a null or repeated doc_id; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.tables import materialise, read, shuffle_width
from ripplecast.llm.text import chunks, split_words, word_hashes

CAPACITY, END_ID = 4096, 1
#: Distinct words whose ids a worker process keeps, and words encoded at a time.
CACHE_WORDS, ENCODE = 1_000_000, 2_000
#: Text bytes tokenised at a time.
CHUNK = 2 << 20
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class WordIds:
    """Token ids of words, encoded once per distinct word (`known` is sorted)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: Iterator[str]) -> None:
        """Words new to the cache, in the order of their sorted hashes."""
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        sizes, flat = [], []
        while some := list(islice(words, ENCODE)):
            got = [e.ids for e in encode(some, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            flat.append(np.fromiter(chain.from_iterable(got), np.uint32, int(sizes[-1].sum())))
        size = np.concatenate(sizes)
        at = np.searchsorted(self.known, hashes)
        self.begin = np.insert(self.begin, at, len(self.ids) + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.known, self.ids = np.insert(self.known, at, hashes), np.concatenate([self.ids, *flat])

    def _knows(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the sorted hashes are in the cache: looked up, the cache is not sorted again."""
        at = np.searchsorted(self.known, hashes)
        found = at < len(self.known)
        found[found] = self.known[at[found]] == hashes[found]
        return found

    def encode(self, buf: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, ids per word)."""
        hashes = word_hashes(buf, words)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._knows(distinct))
        if len(self.known) + len(new) > CACHE_WORDS:
            self._clear()
            new = np.arange(len(distinct))
        if len(new):
            data = buf.tobytes()
            at = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist(), strict=True)
            self._learn(distinct[new], (data[a:b].decode() for a, b in at))
        place = np.searchsorted(self.known, distinct)[inverse]
        size = self.size[place]
        cum = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(cum, size) + np.repeat(self.begin[place], size)
        return self.ids[at], size


def _pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        for c in chunks(batches, size=CHUNK):
            words = split_words(c.buf, c.starts, c.ends)
            ids, size = coder.encode(c.buf, words)
            cum = np.append(0, np.cumsum(size))
            n = cum[words.last] - cum[words.first] + 1
            stop = np.cumsum(n)
            flat = np.full(int(stop[-1]), end_id, "<u4")
            inside = np.ones(len(flat), bool)
            inside[stop - 1] = False
            flat[inside] = ids
            count = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, n[row] - start)
            first, data = (stop - n)[row] + start, memoryview(flat).cast("B")
            parts = [data[4 * a : 4 * (a + m)] for a, m in zip(first.tolist(), length.tolist(), strict=True)]
            crc = np.fromiter(map(zlib.crc32, parts), np.int64, len(parts))
            body = pa.array([bytes(x) for x in parts], pa.binary()) if keep_ids else pa.nulls(len(parts), pa.binary())
            numbers = [pa.array(piece.astype(np.int32)), *map(pa.array, (start, length, crc))]
            names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([c.table.column("doc_id").take(pa.array(row)), *numbers, body], names)

    return run


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One tokenizer and cache per worker process: later tasks find them warm."""
    return WordIds(path)


class _Supply:
    """Available lengths with an index of the pair sums they can form."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, np.int64)
        for length, c in counts.items():
            self.n[length] = c
        self.pairs = np.zeros(2 * capacity + 1, np.int64)  # ordered pairs of available lengths, by their sum
        self.have = np.zeros(capacity + 1, bool)
        for length in np.flatnonzero(self.n):
            self._enter(int(length), 1)

    def _enter(self, length: int, sign: int) -> None:
        if sign > 0:
            self.have[length] = True
        others = np.flatnonzero(self.have)
        self.pairs[others + length] += sign
        self.pairs[others[others != length] + length] += sign
        if sign < 0:
            self.have[length] = False

    def take(self, lengths: list[int], times: int) -> None:
        for length in lengths:
            self.n[length] -= times
            if not self.n[length]:
                self._enter(length, -1)

    def times(self, lengths: list[int]) -> int:
        """How often a combination is available."""
        return min(int(self.n[x]) // lengths.count(x) for x in set(lengths))

    def filling(self, length: int, gap: int) -> list[int] | None:
        """One, two or three available lengths that fill `gap` beside `length`."""

        def usable(more: list[int]) -> bool:
            return self.times([length, *more]) > 0

        if gap <= 0:
            return [] if gap == 0 else None
        if self.have[gap] and usable([gap]):
            return [gap]
        if pair := self._pair(gap, usable, []):
            return pair
        third = np.flatnonzero(self.have[: gap + 1])[::-1]
        third = third[self.pairs[gap - third] > 0]
        for a in third.tolist():
            if triple := self._pair(gap - a, usable, [a]):
                return triple
        return None

    def _pair(self, total: int, usable, more: list[int]) -> list[int] | None:
        if total < 2 or not self.pairs[total]:
            return None
        low = np.flatnonzero(self.have[: total // 2 + 1])
        for a in low[self.have[total - low]][::-1].tolist():
            if usable([*more, total - a, a]):
                return [*more, total - a, a]
        return None


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a sequence, how many such sequences) that hold all pieces.

    Where filling gaps exactly uses up the short pieces too early, best fit alone
    may need fewer sequences; the smaller plan is returned.
    """
    plans = [_fill_exactly(counts, capacity), _best_fit(counts, capacity)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _fill_exactly(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    supply, plan, rest = _Supply(counts, capacity), [], {}
    for length in range(capacity, 0, -1):
        while supply.n[length]:
            more = supply.filling(length, capacity - length)
            if more is None:
                rest[length] = int(supply.n[length])
                supply.take([length], rest[length])
                break
            times = supply.times([length, *more])
            supply.take([length, *more], times)
            plan.append(([length, *more], times))
    return plan + _best_fit(rest, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Longest first, into the tightest gap that holds a piece; else new sequences."""
    gaps: dict[int, list[list]] = defaultdict(list)
    for length, n in sorted(counts.items(), reverse=True):
        while n:
            gap = min((g for g, x in gaps.items() if g >= length and x), default=None)
            if gap is not None:
                lengths, times = gaps[gap].pop()
                used = min(n, times)
                if times > used:
                    gaps[gap].append([lengths, times - used])
                gaps[gap - length].append([[*lengths, length], used])
                n -= used
            else:
                each = min(capacity // length, n)
                used = n // each
                gaps[capacity - each * length].append([[length] * each, used])
                n -= used * each
    return [(x, times) for group in gaps.values() for x, times in group]


def _slots(plan: list[tuple[list[int], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Per length, ranges of ranks: (length, first rank) in order, with first sequence and offset."""
    used, rows, sequence = defaultdict(int), [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    rows.sort()
    length, rank, sequence, offset = np.array(rows, np.int64).reshape(-1, 4).T
    return (length << 40) | rank, sequence, offset


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"


def _place(slots: tuple[np.ndarray, ...], starts: dict[tuple[int, int], tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sequence, offset = slots
        for b in batches:
            length = b.column("length").to_numpy()
            order = b.column("place").to_numpy()
            group, inverse = np.unique(np.stack([order >> 33, length]), axis=1, return_inverse=True)
            first = [starts[(int(p), int(n))] for p, n in group.T]
            base = np.array([x[1] - x[0] for x in first], np.int64)[inverse.ravel()] if first else length
            rank = order + base
            at = np.searchsorted(key, (length << 40) | rank, "right") - 1
            more = [sequence[at] + rank - (key[at] & ((1 << 40) - 1)), offset[at]]
            names = [x.split()[0] for x in PLACED.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column(x) for x in names[:6]] + [pa.array(x) for x in more], names)

    return run


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True,
) -> DataFrame:
    """Every piece of every document with its sequence and offset (and its ids)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = docs.mapInArrow(_pieces(tokenizer, capacity, end_id, keep_ids), PIECE_SCHEMA)
    pieces = materialise(pieces, "packing-pieces")
    # Equal lengths lie in consecutive partitions, in order: place >> 33 is the partition.
    ranged = (
        pieces.repartitionByRange(shuffle_width(docs.sparkSession), "length", "doc_id", "piece", "ids_crc32")
        .sortWithinPartitions("length", "doc_id", "piece")
        .withColumn("place", F.monotonically_increasing_id())
    )
    ranged = materialise(ranged, "packing-ranged")
    # At most one row per length and partition border: capacity + partitions rows.
    part = F.shiftright("place", 33)
    runs = ranged.groupBy(part.alias("part"), "length").agg(F.min("place").alias("first"), F.count("*").alias("n")).collect()
    counts, starts = defaultdict(int), {}
    for r in sorted(runs, key=lambda r: r["part"]):
        starts[(r["part"], r["length"])] = (r["first"], counts[r["length"]])
        counts[r["length"]] += r["n"]
    slots = _slots(pack_lengths(counts, capacity), capacity)
    return ranged.mapInArrow(_place(slots, starts), PLACED)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False).drop("ids")
