"""Line dedup (operator 12): a line that several documents share stays in the least doc_id only.

1. *Keys.* A line's key is its 128-bit BLAKE2 digest after stripping and A-Z lower-casing.
   Every map task reduces its lines to one row a key (least and greatest doc_id,
   documents) before the exchange, so a line of a third of all documents costs a row a task.
2. *Shards.* A key belongs to one shard by its high bits. A shard indexes its distinct
   keys that at least two documents hold (no other line can go) by a minimal perfect hash:
   slot -> 64-bit fingerprint, count of documents, least doc_id. A line of one
   document lands in a foreign slot or none, and its fingerprint tells; a shorter
   fingerprint would drop a single line by chance once in a few billion lines.
3. *Hot keys.* The HOT_KEYS keys of most documents have arrays of their own, which all
   tasks get (at most HOT_KEYS * 28 bytes and the hash). Any other key is in at most
   1 / HOT_KEYS of all lines.
4. *Probes.* Documents probe the hot arrays where they are; their other keys travel, packed,
   to their shard and probe its arrays there, which come first in every partition.
   What is found goes back by doc_id.

Defined results: null or empty text is one empty line; rows with a null doc_id are
returned unchanged and take no part; rows repeating a doc_id are one document (each row is
returned, and keeps its lines against the others); repeated lines of the least document all
stay; extra columns are ignored; an empty table gives no rows. A task's memory is a few
times its longest text: lines are cut from whole texts, without a limit on their length.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.perfect_hash import MinimalHash
from ripplecast.llm.repeats import BLOB_SCHEMA, blob_batch, blobs
from ripplecast.llm.tables import materialise, read, shuffle_width
from ripplecast.llm.text import chunks

LEAST_CHARS = 10
SPACE = b" \t\n\x0b\x0c\r"
#: Lines a map task gathers before it reduces them.
FLUSH_LINES = 1_000_000
#: Keys whose arrays every task gets, and the documents that make a key worth it.
HOT_KEYS, HOT_DOCS = 50_000, 64

KEY = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("least", "<i8"), ("most", "<i8"), ("n", "<u4")])
PROBE = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8")])
#: kinds of packed rows; a shard's arrays sort before its probes
ARRAYS, PROBES, FOUND = 0, 1, 2

INDEX_SCHEMA = BLOB_SCHEMA + ", h1 long, h2 long, least long, n long"
MARK_SCHEMA = "doc_id long, key binary"
SCHEMA = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept string"


def line_key(line: bytes, least: int) -> bytes | None:
    """The digest of a line's key, if the key has at least `least` code points."""
    key = line.strip(SPACE).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _document_keys(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[int, set[bytes]]]:
    for c in chunks(batches):
        for i in np.flatnonzero(c.valid).tolist():
            lines = c.buf[c.starts[i] : c.ends[i]].tobytes().split(b"\n")
            keys = {line_key(x, least) for x in lines}
            keys.discard(None)
            if keys:
                yield int(c.ids[i]), keys


def _gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[np.ndarray]:
    """Rows (h1, h2, doc) of about FLUSH_LINES keys, once a key and document row."""
    digests, docs, counts, size = [], [], [], 0
    for doc, keys in _document_keys(batches, least):
        digests.extend(keys)
        docs.append(doc)
        counts.append(len(keys))
        size += len(keys)
        if size >= FLUSH_LINES:
            yield _probe_rows(digests, docs, counts)
            digests, docs, counts, size = [], [], [], 0
    if size:
        yield _probe_rows(digests, docs, counts)


def _probe_rows(digests: list[bytes], docs: list[int], counts: list[int]) -> np.ndarray:
    out = np.empty(len(digests), PROBE)
    h = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    out["h1"], out["h2"], out["doc"] = h[:, 0], h[:, 1], np.repeat(np.array(docs, np.int64), counts)
    return out[np.lexsort((out["doc"], out["h2"], out["h1"]))]


def reduce_keys(rows: np.ndarray) -> np.ndarray:
    """One row a key: least and greatest document, and the documents counted."""
    rows = rows[np.lexsort((rows["h2"], rows["h1"]))]
    if not len(rows):
        return rows
    new = np.ones(len(rows), bool)
    new[1:] = (rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])
    at = np.flatnonzero(new)
    out = rows[at]
    out["least"] = np.minimum.reduceat(rows["least"], at)
    out["most"] = np.maximum.reduceat(rows["most"], at)
    out["n"] = np.minimum(np.add.reduceat(rows["n"].astype(np.int64), at), 2**32 - 1)
    return out


def _map_keys(width: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for probes in _gathered(batches, least):
            rows = np.empty(len(probes), KEY)
            rows["h1"], rows["h2"], rows["n"] = probes["h1"], probes["h2"], 1
            rows["least"] = rows["most"] = probes["doc"]
            rows = reduce_keys(rows)
            yield blob_batch(list(blobs(rows, rows["h1"], width, PROBES)))

    return run


class LineArrays:
    """Slot of a key -> fingerprint, documents, least doc_id."""

    def __init__(self, hash_: MinimalHash, fingerprint: np.ndarray, count: np.ndarray, least: np.ndarray):
        self.hash, self.fingerprint, self.count, self.least = hash_, fingerprint, count, least

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, count: np.ndarray, least: np.ndarray) -> LineArrays:
        hash_ = MinimalHash.build(h1, h2)
        order = np.empty(len(h1), np.int64)
        order[hash_.slots(h1, h2)] = np.arange(len(h1))
        return cls(hash_, h2[order], count[order].astype("<u4"), least[order])

    def probe(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per probe: the key is indexed; the line goes (an earlier document holds it)."""
        known, goes = np.zeros(len(h1), bool), np.zeros(len(h1), bool)
        slot = self.hash.slots(h1, h2)
        at = np.flatnonzero(slot >= 0)
        at = at[self.fingerprint[slot[at]] == h2[at]]
        known[at] = True
        slot = slot[at]
        goes[at] = (self.count[slot] >= 2) & (self.least[slot] < doc[at])
        return known, goes

    def dump(self) -> bytes:
        parts = (self.fingerprint.astype("<u8"), self.least.astype("<i8"), self.count)
        return self.hash.dump() + b"".join(x.tobytes() for x in parts)

    @classmethod
    def load(cls, body) -> LineArrays:
        hash_, at = MinimalHash.load(body, 0)
        n = hash_.size
        fingerprint, least = np.frombuffer(body, "<u8", n, at), np.frombuffer(body, "<i8", n, at + 8 * n)
        return cls(hash_, fingerprint, np.frombuffer(body, "<u4", n, at + 16 * n), least)


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = defaultdict(list)
    for b in batches:
        for pid, body in zip(b.column("pid").to_pylist(), b.column("body"), strict=True):
            held[pid].append(np.frombuffer(body.as_buffer(), KEY))
    for pid, bodies in held.items():
        yield _shard(pid, reduce_keys(np.concatenate(bodies)))


def _shard(pid: int, rows: np.ndarray) -> pa.RecordBatch:
    """The arrays of a shard's rows, and its keys of most documents."""
    rows = rows[rows["least"] < rows["most"]]
    arrays = LineArrays.build(rows["h1"], rows["h2"], rows["n"], rows["least"])
    hot = rows[rows["n"] >= HOT_DOCS]
    hot = hot[np.argsort(hot["n"], kind="stable")[::-1][:HOT_KEYS]]
    n = len(hot)
    columns = [
        pa.array([pid] * (n + 1), pa.int32()), pa.array([ARRAYS] + [FOUND] * n, pa.int32()),
        pa.array([arrays.dump()] + [None] * n, pa.binary()),
    ]
    for x in (hot["h1"].view(np.int64), hot["h2"].view(np.int64), hot["least"], hot["n"].astype(np.int64)):
        columns.append(pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(np.ascontiguousarray(x))]))
    return pa.RecordBatch.from_arrays(columns, ["pid", "kind", "body", "h1", "h2", "least", "n"])


def _map_probes(width: int, least: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, turn = LineArrays.load(hot.value), 0
        for rows in _gathered(batches, least):
            known, goes = arrays.probe(rows["h1"], rows["h2"], rows["doc"])
            found, rows = rows[goes], rows[~known]
            out = list(blobs(rows, rows["h1"], width, PROBES))
            step = max(1, -(-len(found) // width))
            for a in range(0, len(found), step):  # dealt out evenly: they only pass through
                turn += 1
                out.append((turn % width, FOUND, found[a : a + step].tobytes()))
            yield blob_batch(out)

    return run


def _probe_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Probes against the arrays that lead the partition; (doc_id, key) of lines that go."""
    arrays = None
    for b in batches:
        for kind, body in zip(b.column("kind").to_pylist(), b.column("body"), strict=True):
            if kind == ARRAYS:
                arrays = LineArrays.load(body.as_buffer())
                continue
            rows = np.frombuffer(body.as_buffer(), PROBE)
            if kind == PROBES:
                rows = rows[arrays.probe(rows["h1"], rows["h2"], rows["doc"])[1]]
            key = np.ascontiguousarray(np.stack([rows["h1"], rows["h2"]], axis=1)).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(rows["doc"])),
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(rows), [None, pa.py_buffer(key)]).cast(
                        pa.binary()
                    ),
                ],
                ["doc_id", "key"],
            )


def _digest(least: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            gone = c.table.column("gone").to_pylist()
            n_lines, n_dropped, sha, kept = [], [], [], []
            for i, keys in enumerate(gone):
                text = c.buf[c.starts[i] : c.ends[i]].tobytes()
                count = dropped = text.count(b"\n") + 1
                if keys:
                    drop = set(keys)
                    lines = [x for x in text.split(b"\n") if line_key(x, least) not in drop]
                    text, count = b"\n".join(lines), len(lines)
                n_lines.append(dropped)
                n_dropped.append(dropped - count)
                sha.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    c.table.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                    pa.array(sha, pa.string()), pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"],
            )

    return run


def line_dedup(
    docs: DataFrame, least_chars: int = LEAST_CHARS, id_col: str = "doc_id", text_col: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """Per document: lines, dropped lines, digest and (with `keep_text`) the text that stays."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    index = (
        docs.mapInArrow(_map_keys(width, least_chars), BLOB_SCHEMA)
        .repartitionById(width, F.col("pid"))
        .mapInArrow(_build_shards, INDEX_SCHEMA)
    )
    index = materialise(index, "line-index")
    # At most HOT_KEYS rows of four numbers.
    top = (
        index.where(F.col("kind") == FOUND).select("h1", "h2", "least", "n")
        .orderBy(F.desc("n"), "h1", "h2").limit(HOT_KEYS).toPandas()
    )
    h1, h2 = (top[x].to_numpy(np.int64).view(np.uint64) for x in ("h1", "h2"))
    hot = LineArrays.build(h1, h2, top["n"].to_numpy(np.int64), top["least"].to_numpy(np.int64))
    probes = docs.mapInArrow(_map_probes(width, least_chars, spark.sparkContext.broadcast(hot.dump())), BLOB_SCHEMA)
    marks = (
        index.where(F.col("kind") == ARRAYS)
        .select("pid", "kind", "body")
        .unionByName(probes)
        .repartitionById(width, F.col("pid"))
        .sortWithinPartitions("pid", "kind")
        .mapInArrow(_probe_shards, MARK_SCHEMA)
    )
    gone = marks.groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left").mapInArrow(_digest(least_chars, keep_text), SCHEMA)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents"), keep_text=False).drop("kept")
