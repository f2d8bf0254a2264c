"""Finding every string of W consecutive symbols that also starts earlier.

Shared by the substring (words) and suffix-array (bytes) operators; each brings
its own index for the last step. The search is exact and never compares all pairs:

1. *Super-windows.* The least hashed K-gram of a window (its anchor) depends on
   the window's content alone, so equal windows have equal anchors. Consecutive
   windows of one document with the same anchor form one super-window: about
   2 / (W - K + 2) rows per symbol instead of one.
2. *Local first.* Each map task keeps the first of equal super-windows (by a 64-bit key of the
   anchor and 96 bits of the content) and marks the rest as repeats at once, so a passage held by a third of all documents
   sends at most one row per task and content. An anchor with many different
   super-windows in a task (the edges of a hot passage) is *hot*.
3. *Exchange by anchor.* Rows travel as packed blobs. A super-window equal to an
   earlier one is a repeat. Others of one anchor may share windows still: a window
   reaches half of its other symbols to the left or to the right of its anchor, so
   it is an *edge*, to be looked into, if its anchor and that half is found in another.
4. *Contents.* Edges fetch their symbols from their documents. Hot anchors are
   split into single windows, keyed by the window itself, and reduced to the
   first per task again, comparing the symbols.
5. *Index.* Per partition the operator's index reports windows that start earlier.

Positions are ordered by (doc_id, start). Rows with a null id take no part. Rows
repeating an id are the same document: equal positions are not earlier.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplecast.llm.tables import materialise, shuffle_width
from ripplecast.llm.text import Chunk, chunks, gram_hash, mix, prefix_sums, span_hash

#: Super-windows a map task gathers before it reduces them (bounds its memory).
FLUSH_ROWS = 2_000_000
#: Different super-windows of one anchor in one flush that make it hot.
HOT_CONTEXTS = 32
#: Symbols of one index, and symbols of hot windows that a map task holds.
INDEX_SYMBOLS, HOT_SYMBOLS = 1_000_000, 4_000_000

BLOB_SCHEMA = "pid int, kind int, body binary"
MARK_SCHEMA = "doc_id long, s long, e long, akey long, flag int"
#: flag of a mark: a repeat to remove, an edge, an edge of a hot anchor.
REPEAT, EDGE, HOT = 0, 1, 2

ROW = np.dtype(
    [("akey", "<u8"), ("ckey", "<u8"), ("more", "<u4"), ("doc", "<i8"), ("s", "<u4"), ("n", "<u2"), ("left", "<u2"), ("right", "<u2")]
)
MARK = np.dtype([("doc", "<i8"), ("s", "<u4"), ("e", "<u4"), ("akey", "<u8"), ("flag", "u1")])
PART = np.dtype([("akey", "<u8"), ("doc", "<i8"), ("s", "<u4"), ("n", "<u2"), ("symbols", "<u4")])


@dataclass
class Symbols:
    """The symbols of a chunk: row i holds values[first[i]:last[i]]."""

    values: np.ndarray  # what the index sees
    hashed: np.ndarray  # uint64, for rolling hashes
    first: np.ndarray
    last: np.ndarray


@dataclass(frozen=True)
class Scheme:
    window: int
    gram: int
    symbols: Callable[[Chunk], Symbols]
    dtype: str
    #: (values, row starts, window counts) -> for each symbol position: its window starts earlier
    index: Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def super_windows(sums, others, first, last, window, gram, sides=False):
    """Maximal runs of windows with one anchor: (row, start, windows, anchor key, two content keys).

    The content keys come from two independent sets of prefix sums. Within one anchor the
    first 64 and 32 more bits tell contents apart: 10**10 contents of one
    anchor collide with a chance below 10**-9. With `sides` also a left and a right key, of the anchor and half of
    a window's other symbols beside it, 0 where the run does not reach so far."""
    n = len(sums) - 1
    rows = np.flatnonzero(last - first >= window)
    empty = np.zeros(0, np.int64)
    if not len(rows):
        return empty, empty, empty, *(empty.astype(np.uint64) for _ in range(5 if sides else 3))
    order = mix(gram_hash(sums, gram), 1)
    span = window - gram + 1
    # High half: the gram's rank; low half: its place, so the leftmost least gram wins.
    low = (order & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(order), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        rest = span - width
        low = np.minimum(low[:-rest], low[rest:])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.ones(len(anchor) + 1, bool)
    change[1:-1] = anchor[1:] != anchor[:-1]
    begin, stop = first[rows], last[rows] - window + 1
    change[begin] = True
    valid = np.zeros(n + 1, np.int8)
    np.add.at(valid, begin, 1)
    np.add.at(valid, stop, -1)
    valid = np.cumsum(valid, dtype=np.int8)[: len(anchor)].astype(bool)
    s = np.flatnonzero(change[:-1] & valid)
    of = np.searchsorted(begin, s, "right") - 1
    e = np.minimum(np.append(s[1:], n), stop[of])
    akey = mix(order[anchor[s]], 2)
    ckey, more = (mix(span_hash(x, s, e - 1 + window) ^ (e - s).astype(np.uint64), k) for x, k in ((sums, 3), (others, 5)))
    found = rows[of], s, e - s, akey, ckey, more
    if not sides:
        return found
    half = (window - gram + 1) // 2  # of two parts that make window - gram, one is as long
    at = anchor[s]
    for reaches, lo, hi in ((at - half >= s, at - half, at + gram), (at + gram + half <= e - 1 + window, at, at + gram + half)):
        key = np.zeros(len(s), np.uint64)
        key[reaches] = np.maximum(mix(span_hash(sums, lo[reaches], hi[reaches]), 6) >> np.uint64(48), np.uint64(1))
        found = *found, key
    return found


def pid_of(keys: np.ndarray, width: int) -> np.ndarray:
    """The partition of each key, rising with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)).astype(np.int64)


def blobs(rows: np.ndarray, keys: np.ndarray, width: int, kind: int, extra=None) -> Iterator[tuple[int, int, bytes]]:
    """One blob per partition of `rows`, which are sorted by `keys`."""
    cuts = np.searchsorted(pid_of(keys, width), np.arange(width + 1))
    for p in range(width):
        if cuts[p] < cuts[p + 1]:
            body = rows[cuts[p] : cuts[p + 1]].tobytes()
            yield p, kind, body if extra is None else extra(cuts[p], cuts[p + 1], body)


def blob_batch(items: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    pid, kind, body = zip(*items, strict=True) if items else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(pid, pa.int32()), pa.array(kind, pa.int32()), pa.array(body, pa.binary())], ["pid", "kind", "body"]
    )


def first_of_groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by (akey, ckey, more, doc, s). Returns the rows, `first` flags and `earlier exists` flags."""
    rows = rows[np.lexsort((rows["s"], rows["doc"], rows["more"], rows["ckey"], rows["akey"]))]
    first = np.ones(len(rows), bool)
    for key in ("akey", "ckey", "more"):
        first[1:] &= rows[key][1:] == rows[key][:-1]
    first[1:] = ~first[1:]
    head = np.flatnonzero(first)[np.cumsum(first) - 1] if len(rows) else np.zeros(0, np.int64)
    later = (rows["doc"] != rows["doc"][head]) | (rows["s"] != rows["s"][head])
    return rows, first, later


def _marks(rows: np.ndarray, window: int, flag) -> np.ndarray:
    out = np.empty(len(rows), MARK)
    out["doc"], out["s"], out["akey"], out["flag"] = rows["doc"], rows["s"], rows["akey"], flag
    out["e"] = rows["s"] + rows["n"].astype(np.uint32) + np.uint32(window - 1)
    return out


def merged(marks: np.ndarray) -> np.ndarray:
    """Join touching or overlapping repeats of a document."""
    if not len(marks):
        return marks
    marks = marks[np.lexsort((marks["s"], marks["doc"]))]
    doc, s, e = marks["doc"], marks["s"].astype(np.int64), marks["e"].astype(np.int64)
    group = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    shift = group * (int(e.max()) + 2)
    reach = np.maximum.accumulate(e + shift)
    new = np.ones(len(marks), bool)
    new[1:] = (s + shift)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    out = marks[at]
    out["e"] = np.maximum.reduceat(e, at)
    return out


def _reduce_local(rows: np.ndarray, window: int, width: int, salt: int) -> list[tuple[int, int, bytes]]:
    rows, first, later = first_of_groups(rows)
    repeats = merged(_marks(rows[~first & later], window, REPEAT))
    rows = rows[first]
    starts = np.flatnonzero(np.concatenate([[True], rows["akey"][1:] != rows["akey"][:-1]])) if len(rows) else []
    counts = np.diff(np.append(starts, len(rows)))
    hot = np.repeat(counts >= HOT_CONTEXTS, counts) if len(rows) else np.zeros(0, bool)
    side = [repeats, _marks(rows[hot], window, HOT)]
    marker = np.zeros(int((counts >= HOT_CONTEXTS).sum()) if len(rows) else 0, ROW)
    if len(marker):
        marker["akey"] = rows["akey"][np.asarray(starts)[counts >= HOT_CONTEXTS]]
    rows = np.concatenate([rows[~hot], marker])
    rows = rows[np.argsort(rows["akey"], kind="stable")]
    out = list(blobs(rows, rows["akey"], width, 0))
    side = np.concatenate(side)
    step = max(1, -(-len(side) // width))
    out += [((salt + i) % width, 1, side[a : a + step].tobytes()) for i, a in enumerate(range(0, len(side), step))]
    return out


def _map_super_windows(scheme: Scheme, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, salt = [], 0, 0
        for c in chunks(batches):
            sym = scheme.symbols(c)
            if not len(sym.values):
                continue
            sums, others = prefix_sums(sym.hashed), prefix_sums(mix(sym.hashed, 51))
            row, s, n, akey, ckey, more, left, right = super_windows(
                sums, others, sym.first, sym.last, scheme.window, scheme.gram, sides=True
            )
            ok = c.valid[row]
            out = np.empty(int(ok.sum()), ROW)
            out["akey"], out["ckey"], out["more"], out["n"] = akey[ok], ckey[ok], more[ok] >> np.uint64(32), n[ok]
            out["doc"], out["s"] = c.ids[row[ok]], (s - sym.first[row])[ok]
            out["left"], out["right"] = left[ok], right[ok]
            salt = (salt + int(c.ids[0])) % width
            held.append(out)
            size += len(out)
            if size >= FLUSH_ROWS:
                yield blob_batch(_reduce_local(np.concatenate(held), scheme.window, width, salt))
                held, size = [], 0
        if held:
            yield blob_batch(_reduce_local(np.concatenate(held), scheme.window, width, salt))

    return run


def _mark_batches(marks: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(marks), 100_000):
        m = marks[a : a + 100_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(m["doc"]), pa.array(m["s"].astype(np.int64)), pa.array(m["e"].astype(np.int64)),
                pa.array(np.ascontiguousarray(m["akey"]).view(np.int64)), pa.array(m["flag"].astype(np.int32)),
            ],
            ["doc_id", "s", "e", "akey", "flag"],
        )


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, memoryview]]:
    for b in batches:
        for kind, body in zip(b.column("kind").to_pylist(), b.column("body"), strict=True):
            yield kind, body.as_buffer()


def _meets(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rows whose key another row of their group has (key 0: none)."""
    both = group.astype(np.uint64) << np.uint64(16) | key
    order = np.argsort(both)
    equal = both[order][1:] == both[order][:-1]
    out = np.zeros(len(both), bool)
    out[order[1:][equal]] = out[order[:-1][equal]] = True
    return out & (key > 0)


def _reduce_super_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for kind, body in _bodies(batches):
            if kind == 1:
                yield from _mark_batches(np.frombuffer(body, MARK))
            else:
                held.append(np.frombuffer(body, ROW))
        if not held:
            return
        rows = np.concatenate(held)
        markers = np.unique(rows["akey"][rows["n"] == 0])
        rows, first, later = first_of_groups(rows[rows["n"] > 0])
        yield from _mark_batches(_marks(rows[~first & later], window, REPEAT))
        rows = rows[first]
        if not len(rows):
            return
        group = np.cumsum(np.concatenate([[True], rows["akey"][1:] != rows["akey"][:-1]]))
        hot = np.isin(rows["akey"], markers)
        edge = _meets(group, rows["left"]) | _meets(group, rows["right"]) | hot
        yield from _mark_batches(_marks(rows[edge], window, np.where(hot[edge], HOT, EDGE)))

    return run


def _parts(rows: np.ndarray, values: np.ndarray, width: int, dtype) -> list[tuple[int, int, bytes]]:
    """Blobs of edges with their symbols, sorted by key."""
    begin = np.cumsum(rows["symbols"], dtype=np.int64) - rows["symbols"]
    order = np.argsort(rows["akey"], kind="stable")
    rows, begin = rows[order], begin[order]
    length = rows["symbols"].astype(np.int64)
    cum = np.append(0, np.cumsum(length))
    at = np.arange(cum[-1]) - np.repeat(cum[:-1], length) + np.repeat(begin, length)
    values = values[at].astype(dtype)

    def pack(a: int, b: int, body: bytes) -> bytes:
        return len(body).to_bytes(8, "little") + body + values[cum[a] : cum[b]].tobytes()

    return list(blobs(rows, rows["akey"], width, 0, pack))


def _flush_parts(parts, windows, scheme, width, salt):
    """Edges as they are; windows of hot anchors reduced to the first of each content."""
    out = []
    if windows:
        rows = np.concatenate([w[0] for w in windows])
        values = np.concatenate([w[1] for w in windows]).reshape(len(rows), scheme.window)
        order = np.lexsort((rows["s"], rows["doc"], rows["akey"]))
        rows, values = rows[order], values[order]
        first = np.concatenate([[True], rows["akey"][1:] != rows["akey"][:-1]])
        head = np.flatnonzero(first)[np.cumsum(first) - 1]
        # The symbols themselves decide; windows that only share a hash go to the index as they are.
        first |= (values != values[head]).any(axis=1)
        later = (rows["doc"] != rows["doc"][head]) | (rows["s"] != rows["s"][head])
        side = merged(_marks(rows[~first & later], scheme.window, REPEAT))
        if len(side):
            out.append((salt % width, 1, side.tobytes()))
        parts = [*parts, (rows[first], values[first].ravel())]
    if parts:
        out += _parts(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), width, scheme.dtype)
    return out


def _map_contents(scheme: Scheme, width: int):
    window = scheme.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, windows, size, held, salt = [], [], 0, 0, 0
        for c in chunks(batches):
            sym = scheme.symbols(c)
            edges = c.table.column("edges")
            at = np.diff(np.asarray(edges.offsets))
            of = np.repeat(np.arange(len(c.ids)), at)
            flat = edges.flatten()
            s, e, akey, flag = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            lo, hi = s + sym.first[of], e + sym.first[of]
            ok = hi <= sym.last[of]  # another text under the same id may be shorter
            of, s, lo, hi, akey, flag = (x[ok] for x in (of, s, lo, hi, akey, flag))
            if not len(of):
                continue
            plain = flag == EDGE
            if plain.any():
                length = (hi - lo)[plain]
                rows = np.empty(len(length), PART)
                rows["akey"], rows["doc"], rows["s"] = akey[plain].view(np.uint64), c.ids[of[plain]], s[plain]
                rows["n"], rows["symbols"] = length - window + 1, length
                cum = np.cumsum(length) - length
                idx = np.arange(int(length.sum())) - np.repeat(cum, length) + np.repeat(lo[plain], length)
                parts.append((rows, sym.values[idx]))
                size += len(idx)
            if not plain.all():
                count = (hi - lo - window + 1)[~plain]
                cum = np.cumsum(count) - count
                step = np.arange(int(count.sum())) - np.repeat(cum, count)
                begin = np.repeat(lo[~plain], count) + step
                sums = prefix_sums(sym.hashed)
                whole = np.empty(len(begin), PART)
                whole["akey"] = mix(span_hash(sums, begin, begin + window), 4)
                whole["doc"], whole["s"] = np.repeat(c.ids[of[~plain]], count), np.repeat(s[~plain], count) + step
                whole["n"], whole["symbols"] = 1, window
                views = np.lib.stride_tricks.sliding_window_view(sym.values, window)
                step = max(1, HOT_SYMBOLS // window)
                for a in range(0, len(begin), step):  # a window's symbols are copied for so many at a time
                    windows.append((whole[a : a + step], views[begin[a : a + step]].ravel()))
                    held += len(windows[-1][1])
                    if held >= HOT_SYMBOLS:
                        yield blob_batch(_flush_parts([], windows, scheme, width, salt + a))
                        windows, held = [], 0
            salt += int(c.ids[0])
            if size >= 8 * INDEX_SYMBOLS:
                yield blob_batch(_flush_parts(parts, [], scheme, width, salt))
                parts, size = [], 0
        if parts or windows:
            yield blob_batch(_flush_parts(parts, windows, scheme, width, salt))

    return run


def _reduce_contents(scheme: Scheme):
    window = scheme.window

    def resolve(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        # Text order is (doc_id, start): an earlier place in the text is an earlier start.
        begin = np.cumsum(rows["symbols"], dtype=np.int64) - rows["symbols"]
        order = np.lexsort((rows["s"], rows["doc"]))
        rows, begin = rows[order], begin[order]
        same = np.zeros(len(rows), bool)  # one document twice: equal places are not earlier
        same[1:] = (rows["doc"][1:] == rows["doc"][:-1]) & (rows["s"][1:] == rows["s"][:-1])
        same[1:] &= rows["akey"][1:] == rows["akey"][:-1]
        rows, begin = rows[~same], begin[~same]
        length = rows["symbols"].astype(np.int64)
        starts = np.cumsum(length) - length
        at = np.arange(int(length.sum())) - np.repeat(starts, length) + np.repeat(begin, length)
        hit = scheme.index(values[at], starts, rows["n"].astype(np.int64), window)
        pos = np.flatnonzero(hit)
        of = np.searchsorted(starts, pos, "right") - 1
        out = np.empty(len(pos), MARK)
        out["doc"], out["akey"], out["flag"] = rows["doc"][of], 0, REPEAT
        out["s"] = rows["s"][of] + (pos - starts[of])
        out["e"] = out["s"] + np.uint32(window)
        return merged(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for kind, body in _bodies(batches):
            if kind == 1:
                yield from _mark_batches(np.frombuffer(body, MARK))
                continue
            size = int.from_bytes(memoryview(body)[:8], "little")
            held.append((np.frombuffer(body, PART, size // PART.itemsize, 8), np.frombuffer(body, scheme.dtype, -1, 8 + size)))
        if not held:
            return
        rows, values = (np.concatenate(x) for x in zip(*held, strict=True))
        begin = np.cumsum(rows["symbols"], dtype=np.int64) - rows["symbols"]
        order = np.argsort(rows["akey"], kind="stable")
        rows, begin = rows[order], begin[order]
        # Equal windows have equal keys and those of one row differ: a row alone under its key holds no repeat.
        new = np.flatnonzero(np.concatenate([[True], rows["akey"][1:] != rows["akey"][:-1]]))
        size = np.diff(np.append(new, len(rows)))
        several = np.repeat(size > 1, size)
        rows, begin = rows[several], begin[several]
        if not len(rows):
            return
        new = np.flatnonzero(np.concatenate([[True], rows["akey"][1:] != rows["akey"][:-1]]))
        cum = np.append(0, np.cumsum(rows["symbols"], dtype=np.int64))
        bound = np.append(new, len(rows))
        a = 0
        while a < len(rows):  # whole anchors, up to about INDEX_SYMBOLS symbols each
            k = int(np.searchsorted(cum[bound], cum[a] + INDEX_SYMBOLS, "right")) - 1
            b = int(bound[max(k, int(np.searchsorted(bound, a, "right")))])
            sub = rows[a:b]
            length = sub["symbols"].astype(np.int64)
            c = np.cumsum(length) - length
            at = np.arange(int(length.sum())) - np.repeat(c, length) + np.repeat(begin[a:b], length)
            yield from _mark_batches(resolve(sub, values[at]))
            a = b

    return run


def _per_document(marks: DataFrame, *columns: str) -> DataFrame:
    return marks.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("edges"))


def removed_spans(docs: DataFrame, scheme: Scheme, label: str) -> DataFrame:
    """(doc_id, edges: list of removed symbol intervals s, e) of `docs` (doc_id, text).

    Intervals may overlap. Documents without a repeat have no row.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    marks = (
        docs.mapInArrow(_map_super_windows(scheme, width), BLOB_SCHEMA)
        .repartitionById(width, F.col("pid"))
        .mapInArrow(_reduce_super_windows(scheme.window), MARK_SCHEMA)
    )
    marks = materialise(marks, f"{label}-marks")
    edges = _per_document(marks.where(F.col("flag") != REPEAT), "s", "e", "akey", "flag")
    found = (
        docs.join(edges.hint("shuffle_hash"), "doc_id")
        .mapInArrow(_map_contents(scheme, width), BLOB_SCHEMA)
        .repartitionById(width, F.col("pid"))
        .mapInArrow(_reduce_contents(scheme), MARK_SCHEMA)
    )
    return _per_document(marks.where(F.col("flag") == REPEAT).unionByName(found), "s", "e")


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its removed intervals (null: none)."""
    return docs.join(spans.hint("shuffle_hash"), "doc_id", "left")


def removed_mask(chunk: Chunk, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Per symbol of the chunk: it lies in a removed interval of its row."""
    size = int(last[-1]) if len(last) else 0
    delta = np.zeros(size + 1, np.int32)
    edges = chunk.table.column("edges")
    at = np.diff(np.asarray(edges.offsets))
    at = np.where(np.asarray(edges.is_valid()), at, 0)
    of = np.repeat(np.arange(len(chunk.ids)), at)
    flat = edges.flatten()
    s, e = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
    lo, hi = np.minimum(s + first[of], last[of]), np.minimum(e + first[of], last[of])
    np.add.at(delta, lo, 1)
    np.add.at(delta, hi, -1)
    return np.cumsum(delta[:-1]) > 0
