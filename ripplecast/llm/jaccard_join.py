"""N-gram Jaccard join (operator 8): classes of documents linked at a similarity threshold.

Exact, and without listing the pairs of a group:

1. *Sets.* Every document becomes its set of distinct 5-word shingles (hashes).
   Documents with equal sets are one node, named by the least doc_id.
2. *Candidates.* Two linked sets of sizes m <= M differ in at most
   d = (1/t - 1) * m shingles. Hash both into b = 2d buckets: at least b - d
   buckets hold the same shingles in both, so by the prefix-filter principle they
   share one of the d + 1 fullest buckets (order: fullness, then hash). Those
   bucket contents are the keys. m < M/t lets classes of sizes a factor 1/t
   apart meet by emitting for the own class and the one below. Small sets use
   plain shingles as keys (prefix filter). Per task only the first document of a
   key is sent, the others are tied to it at once: a hot key costs a row a task.
   A second packed exchange gathers a document's ties, found in many partitions,
   and hands on one star for each component of a task: at most one row a node.
3. *Coarse components* over the key edges, which hold every true link. A line of many
   documents ties all that hold it, so components of several blocks are cut once more
   by keys whose order prefers shingles that few of their documents hold. Any order by
   the content alone keeps the prefix-filter principle, so every link is kept.
4. *T-occurrence search* in blocks of a component: an inverted index over the
   block's sets; for each document the short lists are merged to candidates with
   at least T - L occurrences, and the L longest lists are only probed by binary
   search for those (DivideSkip). Survivors are checked exactly.
5. Components of several blocks: the largest clusters of the blocks are searched
   against each other first; then only documents outside a component's largest
   cluster are searched against its other blocks. Two members of one cluster need no
   further check, so no link between different classes is lost.

Defined results: null, empty or word-free text has 0 shingles and links with
nothing; a null doc_id has a null component and links with nothing; rows
repeating a doc_id are one document (each row returned); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.components import connected_components
from ripplecast.llm.repeats import BLOB_SCHEMA, blob_batch, blobs, pid_of
from ripplecast.llm.tables import materialise, read, shuffle_width
from ripplecast.llm.text import chunks, mix, shingle_sets

#: Keys a map task gathers before it reduces them, and their documents (a 16-bit index).
FLUSH_KEYS, FLUSH_DOCS = 4_000_000, 50_000
#: Sets smaller than this use plain shingles as keys.
PLAIN_BELOW = 32
#: Documents of one inverted index.
BLOCK_DOCS = 2048
#: Documents that make a shingle common, and the most frequent ones that the keys' order tells apart.
COMMON_DOCS, COMMON_SHINGLES = 4, 1 << 17
#: Shingles of the sets whose keys are made at once.
KEYS_AT_ONCE = 500_000
#: DivideSkip's weight of a binary probe.
MU = 0.05

NODE_SCHEMA = "kind int, doc_id long, other long, n long, h1 long, h2 long"
EDGE, DOC = 0, 1
DIGEST = np.dtype([("doc", "<i8"), ("valid", "?"), ("n", "<i8"), ("h1", "<u8"), ("h2", "<u8")])


def size_classes(largest: int, percent: int) -> np.ndarray:
    """Class starts t with t[k+1] > t[k] / threshold, from 1 beyond `largest`."""
    t = [1]
    while t[-1] <= largest or len(t) < 3:
        t.append(t[-1] * 100 // percent + 1)
    return np.array(t, np.int64)


def _segments(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each element, and its place in it."""
    of = np.repeat(np.arange(len(count)), count)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)


def candidate_keys(
    row: np.ndarray, value: np.ndarray, rows: int, percent: int, common: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): linked sets share at least one key. `common`: documents of each value, 0 if few."""
    size = np.bincount(row, minlength=rows)
    first = np.cumsum(size) - size
    t = size_classes(int(size.max(initial=1)), percent)
    own = np.searchsorted(t, size, "right") - 1
    some = np.flatnonzero(size > 0)
    # Emissions: own class and the one below, which may hold smaller partners.
    doc = np.concatenate([some, some[own[some] > 0]])
    cls = np.concatenate([own[some], own[some[own[some] > 0]] - 1])
    plain = t[cls] < PLAIN_BELOW
    out_row, out_key = [], []

    p = np.unique(doc[plain])
    if len(p):
        n = size[p]
        of, at = _segments(n)
        at = first[p][of] + at
        v = mix(value[at], 21)
        order = np.lexsort((v, of) if common is None else (v, common[at], of))
        of, v = of[order], v[order]
        take = _segments(n)[1] < (n - -(-percent * n // 100) + 1)[of]
        out_row.append(p[of[take]])
        out_key.append(v[take])

    doc, cls = doc[~plain], cls[~plain]
    if len(doc):
        d = (100 - percent) * (t[cls + 1] - 1) // percent
        b = 2 * d
        base = np.cumsum(b) - b
        of, at = _segments(size[doc])
        place = first[doc][of] + at
        v = mix(value[place], 22)
        slot = base[of] + ((v >> np.uint64(32)) * b[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        total = int(b.sum())
        content = np.zeros(total, np.uint64)
        np.add.at(content, slot, mix(v, 23))
        full = np.bincount(slot, minlength=total)
        if common is not None:
            rare = np.bincount(slot[common[place] == 0], minlength=total)
        of, at = _segments(b)
        key = mix(content ^ mix((cls[of].astype(np.uint64) << np.uint64(40)) + at.astype(np.uint64), 24), 25)
        if common is None:
            emission = of.astype(np.uint64)  # fewer than 2**15
            rank = (emission << np.uint64(48)) | ((63 - np.minimum(full, 63)).astype(np.uint64) << np.uint64(42))
            order = np.argsort(rank | (key >> np.uint64(22)))
        else:
            order = np.lexsort((key, -full, -rare, of))
        take = order[at < d[of] + 1]  # `of` is sorted, so places within an emission line up
        out_row.append(doc[of[take]])
        out_key.append(key[take])
    if not out_row:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_row), np.concatenate(out_key)


def _pairs(doc: np.ndarray, other: np.ndarray) -> np.ndarray:
    differ = doc != other
    both = np.stack([doc[differ], other[differ]], 1)
    return np.unique(both, axis=0) if len(both) else both.reshape(0, 2)


def _stars(edges: np.ndarray) -> np.ndarray:
    """(node, least node of its component) for all but the least: the edges' components, one row a node."""
    node, index = np.unique(edges, return_inverse=True)
    a, b = index.reshape(-1, 2).T
    label = np.arange(len(node))
    while len(a):
        u, v = label[a], label[b]
        open_ = u != v
        a, b, u, v = a[open_], b[open_], u[open_], v[open_]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while len(a) and (label[label] != label).any():
            label = label[label]
    far = np.flatnonzero(label != np.arange(len(node)))
    return np.stack([node[far], node[label[far]]], 1)


def _group_first(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys and documents, the first document of each key, and where keys begin."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return key, doc, doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(key) else doc, new


def _flush_keys(keys: list, docs: list, digests: list, width: int, salt: int) -> list[tuple[int, int, bytes]]:
    out = []
    if digests:
        out.append((salt % width, 2, np.concatenate(digests).tobytes()))
    if keys:
        key, doc, head, new = _group_first(np.concatenate(keys), np.concatenate(docs))
        edges = _pairs(doc, head)
        if len(edges):
            out.append(((salt + 1) % width, 1, edges.astype("<i8").tobytes()))
        key, doc = key[new], doc[new]
        table, index = np.unique(doc, return_inverse=True)
        cuts = np.searchsorted(pid_of(key, width), np.arange(width + 1))
        for p in range(width):
            a, b = cuts[p], cuts[p + 1]
            if a < b:
                used, idx = np.unique(index[a:b], return_inverse=True)
                k = key[a:b]
                # The partition implies the high bits: 48 low bits tell its keys apart.
                out.append((p, 0, b"".join((
                    len(k).to_bytes(8, "little"), len(used).to_bytes(8, "little"), table[used].astype("<i8").tobytes(),
                    (k & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
                    (k >> np.uint64(32) & np.uint64(0xFFFF)).astype("<u2").tobytes(), idx.astype("<u2").tobytes(),
                ))))
    return out


def _map_keys(width: int, percent: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, digests, size, n_docs, salt = [], [], [], 0, 0, 0
        for c in chunks(batches):
            row, value = shingle_sets(c.buf, c.starts, c.ends, k)
            rows = len(c.ids)
            digest = np.zeros(rows, DIGEST)
            digest["doc"], digest["valid"], digest["n"] = c.ids, c.valid, np.bincount(row, minlength=rows)
            for name, seed in (("h1", 7), ("h2", 8)):
                acc = np.zeros(rows, np.uint64)
                np.add.at(acc, row, mix(value, seed))
                digest[name] = acc
            digests.append(digest)
            # One document of equal sets of the chunk; the others follow it by their set's hash.
            ok = np.flatnonzero(c.valid & (digest["n"] > 0))
            order = ok[np.lexsort((c.ids[ok], digest["h2"][ok], digest["h1"][ok]))]
            h = digest[["h1", "h2"]][order]
            chosen = np.zeros(rows, bool)
            chosen[order[np.concatenate([[True], h[1:] != h[:-1]])] if len(order) else order] = True
            keep = chosen[row]
            of, key = candidate_keys(row[keep], value[keep], rows, percent)
            keys.append(key)
            docs.append(c.ids[of])
            size, n_docs, salt = size + len(key), n_docs + rows, salt + int(c.ids[0]) + 1
            if size >= FLUSH_KEYS or n_docs >= FLUSH_DOCS - 16384:
                yield blob_batch(_flush_keys(keys, docs, digests, width, salt))
                keys, docs, digests, size, n_docs = [], [], [], 0, 0
        if digests:
            yield blob_batch(_flush_keys(keys, docs, digests, width, salt))

    return run


def _node_batch(kind: int, doc, other=None, n=None, h1=None, h2=None, mask=None) -> pa.RecordBatch:
    size = len(doc)
    col = lambda x: pa.nulls(size, pa.int64()) if x is None else pa.array(np.ascontiguousarray(x).view(np.int64))
    ids = pa.array(np.ascontiguousarray(doc), pa.int64(), mask=mask)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, kind, np.int32)), ids, *map(col, (other, n, h1, h2))],
        ["kind", "doc_id", "other", "n", "h1", "h2"],
    )


def _reduce_keys(width: int):
    """Ties of each key's documents to its first, packed for the partitions of the tied documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, ties = [], [], []
        for b in batches:
            for pid, kind, scalar in zip(b.column("pid").to_pylist(), b.column("kind").to_pylist(), b.column("body"), strict=True):
                body = scalar.as_buffer()
                if kind == 2:
                    yield blob_batch([(pid, 2, body.to_pybytes())])
                elif kind == 1:
                    ties.append(np.frombuffer(body, "<i8").reshape(-1, 2))
                else:
                    n, used = np.frombuffer(body, "<u8", 2)
                    n, used = int(n), int(used)
                    at = 16 + 8 * used
                    table = np.frombuffer(body, "<i8", used, 16)
                    low = np.frombuffer(body, "<u4", n, at).astype(np.uint64)
                    high = np.frombuffer(body, "<u2", n, at + 4 * n).astype(np.uint64)
                    keys.append(high << np.uint64(32) | low)
                    docs.append(table[np.frombuffer(body, "<u2", n, at + 6 * n)])
        if keys:
            _, doc, head, _ = _group_first(np.concatenate(keys), np.concatenate(docs))
            ties.append(_pairs(doc, head))
        if ties:
            ties = np.concatenate(ties)
            place = mix(ties[:, 0].astype(np.uint64), 26)
            order = np.argsort(place)
            yield blob_batch(list(blobs(ties[order].astype("<i8"), place[order], width, 1)))

    return run


def _merge_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ties, size = [], 0
    for b in batches:
        for kind, scalar in zip(b.column("kind").to_pylist(), b.column("body"), strict=True):
            body = scalar.as_buffer()
            if kind == 2:
                x = np.frombuffer(body, DIGEST)
                yield _node_batch(DOC, x["doc"], None, x["n"], x["h1"], x["h2"], ~x["valid"])
            else:
                ties.append(np.frombuffer(body, "<i8").reshape(-1, 2))
                size += len(ties[-1])
                if size >= FLUSH_KEYS:
                    ties, size = [_stars(np.concatenate(ties))], 0
    if ties:
        edges = _stars(np.concatenate(ties))
        yield _node_batch(EDGE, edges[:, 0], edges[:, 1])


def _token_places(tokens: np.ndarray, width: int) -> np.ndarray:
    """48 bits of a shingle: its partition and 32 bits that tell the partition's shingles apart."""
    h = mix(tokens, 27)
    return pid_of(h, width).astype(np.uint64) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def _counts(places: np.ndarray, width: int) -> list[tuple[int, int, bytes]]:
    place, n = np.unique(places, return_counts=True)
    cuts = np.searchsorted(place, np.arange(width + 1, dtype=np.uint64) << np.uint64(32))
    low, n = place.astype("<u4"), n.astype("<u4")  # the partition is the blob's
    return [(p, 0, low[a:b].tobytes() + n[a:b].tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def _map_counts(width: int):
    """Documents of a task that hold each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for x in b.column("tokens"):
                held.append(np.frombuffer(x.as_buffer(), "<u8"))
                size += len(held[-1])
                if size >= FLUSH_KEYS:
                    yield blob_batch(_counts(_token_places(np.concatenate(held), width), width))
                    held, size = [], 0
        if held:
            yield blob_batch(_counts(_token_places(np.concatenate(held), width), width))

    return run


def _reduce_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of COMMON_DOCS documents and more."""
    low, n = {}, {}
    for b in batches:
        for pid, scalar in zip(b.column("pid").to_pylist(), b.column("body"), strict=True):
            body = np.frombuffer(scalar.as_buffer(), "<u4").reshape(2, -1)
            low.setdefault(pid, []).append(body[0])
            n.setdefault(pid, []).append(body[1])
    for pid in low:
        key, index = np.unique(np.concatenate(low[pid]), return_inverse=True)
        docs = np.bincount(index, np.concatenate(n[pid])).astype(np.int64)
        often = docs >= COMMON_DOCS
        place = np.int64(pid) << np.int64(32) | key[often].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(docs[often])], ["place", "docs"])


def _map_rare_keys(width: int, percent: int, places: np.ndarray, docs: np.ndarray):
    """The keys of sets, by the order that prefers shingles not among `places` (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, size, n_docs, salt = [], [], 0, 0, 0
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            tokens = [np.frombuffer(x.as_buffer(), "<u8") for x in b.column("tokens")]
            ends = np.cumsum([len(x) for x in tokens])
            a = 0
            while a < len(ids):
                z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + KEYS_AT_ONCE, "right")))
                z = min(z, a + 16384)
                value = np.concatenate(tokens[a:z])
                common = np.zeros(len(value), np.int64)
                if len(places):
                    asked = _token_places(value, width)
                    at = np.minimum(np.searchsorted(places, asked), len(places) - 1)
                    common = np.where(places[at] == asked, docs[at], 0)
                row = np.repeat(np.arange(z - a), [len(x) for x in tokens[a:z]])
                of, key = candidate_keys(row, value, z - a, percent, common)
                keys.append(key)
                held.append(ids[a:z][of])
                size, n_docs, salt = size + len(key), n_docs + z - a, salt + int(ids[a]) + 1
                if size >= FLUSH_KEYS or n_docs >= FLUSH_DOCS - 16384:
                    yield blob_batch(_flush_keys(keys, held, [], width, salt))
                    keys, held, size, n_docs = [], [], 0, 0
                a = z
        if keys:
            yield blob_batch(_flush_keys(keys, held, [], width, salt))

    return run


class InvertedLists:
    """Inverted lists of a block of sets, and T-occurrence search over them."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.size = np.array([len(s) for s in sets], np.int64)
        token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(sets)), self.size)
        order = np.lexsort((doc, token))
        self.doc = doc[order]
        self.tokens, self.first = np.unique(token[order], return_index=True)
        self.stop = np.append(self.first[1:], len(token)).astype(np.int64)
        # (list, document) in one sorted key, for binary probes.
        self.pair = np.repeat(np.arange(len(self.tokens)), self.stop - self.first) * len(sets) + self.doc

    def links(self, query: np.ndarray, open_docs: np.ndarray) -> np.ndarray:
        """Documents of the block, among those flagged in `open_docs`, that link with `query`."""
        q, docs = len(query), len(self.size)
        need = -(-self.percent * q // 100)  # overlap >= t * union >= t * |query|
        at = np.searchsorted(self.tokens, query)
        at = np.minimum(at, max(0, len(self.tokens) - 1))
        lists = at[self.tokens[at] == query] if len(self.tokens) else at[:0]
        if len(lists) < need:
            return np.zeros(0, np.int64)
        length = self.stop[lists] - self.first[lists]
        lists, length = lists[np.argsort(length)], np.sort(length)
        n_long = min(need - 1, int(need / (MU * np.log2(max(2, int(length[-1]))) + 1)))
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        of, place = _segments(self.stop[short] - self.first[short])
        count = np.bincount(self.doc[self.first[short][of] + place], minlength=docs)
        fits = (100 * self.size >= self.percent * q) & (self.percent * self.size <= 100 * q)
        found = np.flatnonzero((count >= need - n_long) & fits & open_docs)
        if not len(found):
            return found
        count = count[found]
        if len(long):
            probe = (long[:, None] * docs + found).ravel()
            hit = self.pair[np.minimum(np.searchsorted(self.pair, probe), len(self.pair) - 1)] == probe
            count = count + hit.reshape(len(long), -1).sum(0)
        return found[100 * count >= self.percent * (q + self.size[found] - count)]


def cluster_block(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Cluster of every set of a block: the least index reachable by links."""
    index, parent = InvertedLists(sets, percent), np.arange(len(sets))
    # Members of the first cluster need no search of their own once they are in it.
    for x in range(len(sets)):
        if x and parent[x] == parent[0]:
            continue
        got = index.links(sets[x], parent != parent[x])
        if len(got):
            labels = np.unique(np.append(parent[got], parent[x]))
            parent[np.isin(parent, labels)] = labels[0]
    return parent


SET_SCHEMA = "doc_id long, comp long, nb int, block int, tokens binary"


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            row, value = shingle_sets(c.buf, c.starts, c.ends, k)
            cut = np.searchsorted(row, np.arange(len(c.ids) + 1))
            body = [value[cut[i] : cut[i + 1]].tobytes() for i in range(len(c.ids))]
            cols = [c.table.column(x) for x in ("doc_id", "comp", "nb", "block")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(body, pa.binary())], ["doc_id", "comp", "nb", "block", "tokens"])

    return run


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    cols, tokens = [[] for _ in names], []
    for b in batches:
        for x, name in zip(cols, names, strict=True):
            x.append(b.column(name).to_numpy(zero_copy_only=False))
        tokens += [np.frombuffer(x.as_buffer(), "<u8") for x in b.column("tokens")]
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in cols], tokens


def _blocks(order: np.ndarray, comp: np.ndarray, block: np.ndarray) -> list[np.ndarray]:
    """`order`, sorted by (comp, block), cut at their changes."""
    change = (np.diff(comp[order]) != 0) | (np.diff(block[order]) != 0)
    return np.split(order, np.flatnonzero(change) + 1) if len(order) else []


CLUSTER_SCHEMA = "doc_id long, comp long, nb int, block int, cluster long, tokens binary"


def _cluster(percent: int):
    """Clusters of each (comp, block) of a partition. Components of several blocks keep their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (doc, comp, nb, block), tokens = _rows(batches, ("doc_id", "comp", "nb", "block"))
        for at in _blocks(np.lexsort((doc, block, comp)), comp, block):
            at = at[np.append(True, np.diff(doc[at]) != 0)]  # one document twice
            label = cluster_block([tokens[i] for i in at], percent)
            kept = [tokens[i].tobytes() if nb[i] > 1 else None for i in at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[at]), pa.array(comp[at]), pa.array(nb[at].astype(np.int32)), pa.array(block[at].astype(np.int32)),
                    pa.array(doc[at][label]), pa.array(kept, pa.binary()),
                ],
                ["doc_id", "comp", "nb", "block", "cluster", "tokens"],
            )

    return run


def _search(percent: int):
    """Search the queries of each (comp, block) against its documents: links between clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (comp, block, cluster, query), tokens = _rows(batches, ("comp", "block", "cluster", "query"))
        order = np.lexsort((query, block, comp))
        for at in _blocks(order, comp, block):
            own, asked = at[query[at] == 0], at[query[at] == 1]
            index, label = InvertedLists([tokens[i] for i in own], percent), cluster[own]
            out = set()
            for i in asked:
                out.update((int(cluster[i]), int(x)) for x in np.unique(label[index.links(tokens[i], label != cluster[i])]))
            if out:
                u, v = zip(*sorted(out), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _blocked(coarse: DataFrame, block_docs: int) -> DataFrame:
    """(doc_id, comp, nb, block) of the nodes of components."""
    size = coarse.groupBy("component").agg(F.ceil(F.count("*") / block_docs).cast("int").alias("nb"))
    return coarse.join(size, "component").select(
        F.col("node").alias("doc_id"), F.col("component").alias("comp"), "nb",
        F.pmod(F.hash("node"), F.col("nb")).cast("int").alias("block"),
    )


def _finer(sets: DataFrame, percent: int, block_docs: int, width: int) -> DataFrame:
    """`sets` with finer components in place of those of several blocks; sets that meet no other go."""
    big = sets.where("nb > 1").select("doc_id", "tokens")
    if big.isEmpty():
        return sets
    counts = big.mapInArrow(_map_counts(width), BLOB_SCHEMA).repartitionById(width, F.col("pid"))
    counts = counts.mapInArrow(_reduce_counts, "place long, docs long")
    most = counts.orderBy(F.desc("docs"), "place").limit(COMMON_SHINGLES).toArrow()
    places, docs = (most.column(x).to_numpy() for x in ("place", "docs"))
    order = np.argsort(places)
    edges = (
        big.mapInArrow(_map_rare_keys(width, percent, places[order].astype(np.uint64), docs[order]), BLOB_SCHEMA)
        .repartitionById(width, F.col("pid"))
        .mapInArrow(_reduce_keys(width), BLOB_SCHEMA)
        .repartitionById(width, F.col("pid"))
        .mapInArrow(_merge_ties, NODE_SCHEMA)
    )
    todo = _blocked(connected_components(edges.select(F.col("doc_id").alias("u"), F.col("other").alias("v")), "jaccard-fine"), block_docs)
    return sets.where("nb = 1").unionByName(big.join(todo.hint("shuffle_hash"), "doc_id").select(*sets.columns))


def _regroup(labels: DataFrame, edges: DataFrame, label: str) -> DataFrame:
    """`labels` with `cluster` replaced after joining clusters by `edges` (u, v).

    Only clusters that meet another are listed: a small table beside the labelled sets.
    """
    roots = connected_components(edges, label).select(F.col("node").alias("cluster"), "component")
    columns = [F.coalesce("component", "cluster").alias(c) if c == "cluster" else F.col(c) for c in labels.columns]
    return labels.join(roots, "cluster", "left").select(*columns)


def _clusters(sets: DataFrame, percent: int, block_docs: int, width: int) -> DataFrame:
    """(doc_id, cluster) of the candidate sets; exact within each coarse component."""
    key = F.pmod(F.xxhash64("comp", "block"), F.lit(width)).cast("int")
    columns = ("doc_id", "comp", "nb", "block", "tokens")
    local = sets.select(*columns).repartitionById(width, key).mapInArrow(_cluster(percent), CLUSTER_SCHEMA)
    local = materialise(local, "jaccard-local")
    big = local.where("nb > 1")
    if big.select("doc_id").isEmpty():
        return local.select("doc_id", "cluster")
    # The largest cluster of every block, by its least document, against each other.
    counts = big.groupBy("comp", "block", "cluster").count()
    leaders = counts.groupBy("comp", "block").agg(F.max_by("cluster", F.struct("count", "cluster")).alias("doc_id"))
    groups = leaders.groupBy("comp").agg(F.ceil(F.count("*") / block_docs).cast("int").alias("parts"))
    leaders = materialise(leaders.select("comp", "doc_id").join(groups, "comp").select("doc_id", "parts"), "jaccard-leaders")
    heads = big.where("doc_id = cluster").join(leaders, "doc_id")
    met = (
        heads.select("doc_id", "comp", F.lit(1).alias("nb"), F.pmod(F.hash("doc_id"), F.col("parts")).alias("block"), "tokens")
        .repartitionById(width, key).mapInArrow(_cluster(percent), CLUSTER_SCHEMA)
    )
    big = _regroup(big, met.select(F.col("doc_id").alias("u"), F.col("cluster").alias("v")), "jaccard-leaders")
    labels = materialise(big.drop("tokens"), "jaccard-big")
    # Everything outside a component's largest cluster, against all blocks of the component.
    sizes = labels.groupBy("comp", "cluster").count()
    largest = sizes.groupBy("comp").agg(F.max_by("cluster", F.struct("count", "cluster")).alias("largest"))
    largest = materialise(largest, "jaccard-largest")
    own = big.select("comp", "block", "cluster", F.lit(0).alias("query"), "tokens")
    every = F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block")
    asked = big.join(largest, "comp").where("cluster <> largest").select("comp", every, "cluster", F.lit(1).alias("query"), "tokens")
    links = own.unionByName(asked).repartitionById(width, key).mapInArrow(_search(percent), "u long, v long")
    done = _regroup(labels, links, "jaccard-links").select("doc_id", "cluster")
    return materialise(local.where("nb = 1").select("doc_id", "cluster").unionByName(done), "jaccard-clusters")


def jaccard_classes(
    docs: DataFrame, percent: int = 80, shingle: int = 5, block_docs: int = BLOCK_DOCS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (least doc_id reachable by links)."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nodes = (
        docs.mapInArrow(_map_keys(width, percent, shingle), BLOB_SCHEMA)
        .repartitionById(width, F.col("pid"))
        .mapInArrow(_reduce_keys(width), BLOB_SCHEMA)
        .repartitionById(width, F.col("pid"))
        .mapInArrow(_merge_ties, NODE_SCHEMA)
    )
    nodes = materialise(nodes, "jaccard-nodes")
    rows = nodes.where(F.col("kind") == DOC).select("doc_id", "n", "h1", "h2")
    full = rows.where("n > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    rep_of = materialise(full.select("doc_id", "h1", "h2").join(reps, ["h1", "h2"]).select("doc_id", "h1", "h2", "rep"), "jaccard-reps")
    alias = rep_of.groupBy("doc_id").agg(F.min("rep").alias("rep"))
    edges = nodes.where(F.col("kind") == EDGE).select("doc_id", "other").distinct()
    edges = (
        edges.join(alias.select("doc_id", F.col("rep").alias("u")), "doc_id")
        .join(alias.select(F.col("doc_id").alias("other"), F.col("rep").alias("v")), "other")
        .select("u", "v")
    )
    coarse = connected_components(edges, "jaccard")
    todo = _blocked(coarse, block_docs)
    sets = docs.join(todo.hint("shuffle_hash"), "doc_id").mapInArrow(_sets(shingle), SET_SCHEMA)
    sets = _finer(materialise(sets, "jaccard-sets"), percent, block_docs, width)
    clusters = _clusters(sets, percent, block_docs, width)
    final = clusters.groupBy("cluster").agg(F.min("doc_id").alias("component"))
    of_rep = clusters.join(final, "cluster").select(F.col("doc_id").alias("rep"), "component")
    named = rep_of.join(of_rep, "rep", "left").select("doc_id", "h1", "h2", F.coalesce("component", "rep").alias("component"))
    return rows.join(named.dropDuplicates(["doc_id", "h1", "h2"]), ["doc_id", "h1", "h2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` whose document is the least of its class (null ids stay)."""
    classes = jaccard_classes(docs, id_col=id_col, **options)
    copies = classes.where("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(copies.hint("shuffle_hash"), id_col, "left_anti")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read(spark, sf_dir, "documents"))
