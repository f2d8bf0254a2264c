"""Cross-tokenizer alignment (operator 11): groups and links between two tokenizations of every text.

1. *Blocks.* A map task encodes its documents, distinct units (words) once per worker
   process, and gathers blocks of BLOCK_UNITS units: documents as unit numbers, units as
   numbers of the block's distinct id pairs, pairs with their count in the block.
2. *Fast path.* A precomputed array leads from an A id to the B id of the same bytes. Such one-to-one
   groups are counted in vectors of the length of A's vocabulary, added up per task and then
   over the tasks, and looked up in the total vector, which every task gets (a long an id).
3. *Pair shuffle.* Only pairs of irregular groups travel: a block asks once for each of
   its distinct pairs, so a pair of a third of all links costs a row a block. A pair's partition adds
   the blocks' counts up, answers each block, and gives the highest count of every B id
   (a long an id of B's vocabulary, for all tasks).
4. A block meets its answers; counts go from pairs over units to documents.

An A and a B token that end together without starting together never have the same bytes, so a
pair is either always one-to-one with equal bytes or always irregular. A one-to-one group whose B id
is not the array's (another token of the same bytes) counts as irregular.

Defined results: null or empty texts, and texts that a tokenizer changes, have no tokens: zeros and an
empty `groups`; every row counts as a document of its own, also with a null or repeated doc_id; extra
columns are ignored; an empty table gives no rows. A task holds a chunk of about a megabyte of text or one
longer text with its units (a few times its size), a block, and a bounded cache of units.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.repeats import pid_of
from ripplecast.llm.tables import materialise, read, shuffle_width
from ripplecast.llm.text import chunks, mix
from ripplecast.llm.tokenizer_links import CACHE_UNITS, unit_links

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Units of a block, and text bytes encoded at a time.
BLOCK_UNITS, CHUNK = 200_000, 1 << 20

BLOCK_SCHEMA = (
    "block long, docs binary, units binary, sizes binary, links binary, same binary, b_ids binary, "
    "asks array<struct<pid:int,body:binary>>, vector binary"
)
ANSWER_SCHEMA = "block long, pid int, body binary, best binary"
ASK = np.dtype([("pair", "<u8"), ("n", "<i8")])
SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, groups string"
)


def _narrow(values: np.ndarray) -> bytes:
    """As 16-bit numbers where they fit, else 32; the first byte tells."""
    wide = len(values) and int(values.max()) >= 1 << 16
    return (b"\4" if wide else b"\2") + values.astype("<u4" if wide else "<u2").tobytes()


def _widen(body: bytes) -> np.ndarray:
    return np.frombuffer(body, "<u4" if body[0] == 4 else "<u2", -1, 1).astype(np.int64)


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _segments(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start[i] .. start[i] + size[i] - 1 of all segments, end to end."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class _Block:
    """Documents gathered for one row of the block table."""

    def __init__(self):
        self.ids, self.units, self.numbers, self.sha, self.text = [], [], [], [], []
        self.size = 0

    def add(self, doc_id, units: np.ndarray, numbers, sha, text) -> None:
        self.ids.append(doc_id)
        self.units.append(units)
        self.numbers.append(numbers)
        self.sha.append(sha)
        self.text.append(text)
        self.size += len(units) + 1

    def row(self, block: int, links, width: int) -> dict:
        sizes, starts, all_links = links.tables()
        count = np.array([len(x) for x in self.units], np.int64)
        unit, of = np.unique(np.concatenate(self.units), return_inverse=True)
        n_links = sizes[2][unit]
        flat = all_links[_segments(starts[unit], n_links)]
        pairs, link = np.unique(flat, return_inverse=True)
        times = np.repeat(np.bincount(of, minlength=len(unit)), n_links)
        n = np.bincount(link, weights=times, minlength=len(pairs)).astype(np.int64)
        a, b = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        same = links.identity[a] == b
        vector = np.bincount(a[same], weights=n[same], minlength=len(links.identity)).astype(np.int64)
        # Local numbers: same-bytes pairs first, then the others by the partition that counts them.
        key = mix(pairs, 41)
        order = np.concatenate([np.flatnonzero(same), (other := np.flatnonzero(~same))[np.argsort(key[other])]])
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(order))
        other = order[int(same.sum()) :]
        ask = np.empty(len(other), ASK)
        ask["pair"], ask["n"] = pairs[other], n[other]
        cut = np.searchsorted(pid_of(key[other], width), np.arange(width + 1))
        docs = pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids, pa.int64()), *(pa.array(x, pa.int64()) for x in np.array(self.numbers).T),
                pa.array(count), pa.array(self.sha, pa.string()), pa.array(self.text, pa.string()),
            ],
            ["doc_id", "n_a", "n_b", "n_groups", "units", "sha", "text"],
        )
        return {
            "block": block, "docs": _ipc(docs), "units": _narrow(of), "sizes": _narrow(n_links),
            "links": _narrow(place[link]), "same": _narrow(a[order[: int(same.sum())]]), "b_ids": _narrow(b[other]),
            "asks": [{"pid": p, "body": ask[cut[p] : cut[p + 1]].tobytes()} for p in range(width) if cut[p] < cut[p + 1]],
        }, vector


def _blocks(a_path: str, b_path: str, width: int, keep_text: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, held, made = unit_links(a_path, b_path), _Block(), 0
        vector = np.zeros(len(links.identity), np.int64)
        first = TaskContext.get().partitionId() << 32

        def flush():
            nonlocal held, made, vector
            row, more = held.row(first + made, links, width)
            held, made, vector = _Block(), made + 1, vector + more
            return pa.RecordBatch.from_pylist([row | {"vector": None}], schema)

        none = np.zeros(0, np.int64)
        for c in chunks(batches, size=CHUNK):
            if len(links) > CACHE_UNITS:
                if held.ids:
                    yield flush()
                links.clear()
            texts = [c.buf[a:b].tobytes().decode() for a, b in zip(c.starts, c.ends, strict=True)]
            some = [i for i, x in enumerate(texts) if x]
            cut = dict(zip(some, links.cut([texts[i] for i in some]), strict=True))
            sizes = links.tables()[0]
            for i, doc_id in enumerate(c.table.column("doc_id").to_pylist()):
                units = np.array(cut.get(i, none), np.int64)
                numbers = sizes[:, units]
                if not len(units) or not numbers[3].all():
                    held.add(doc_id, none, (0, 0, 0), "", "" if keep_text else None)
                    continue
                groups = b";".join([links.text[u] for u in cut[i]])
                sha = hashlib.sha256(groups).hexdigest()
                held.add(doc_id, units, numbers[:3].sum(axis=1), sha, groups.decode() if keep_text else None)
                if held.size >= BLOCK_UNITS:
                    yield flush()
        if held.ids:
            yield flush()
        if vector.any():
            yield pa.RecordBatch.from_pylist([{"vector": vector.tobytes()}], schema)

    return run


def _vector_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors of this task, added up, as (id, n) rows."""
    total = 0
    for b in batches:
        for body in b.column("vector"):
            total = total + np.frombuffer(body.as_buffer(), np.int64)
    if not isinstance(total, int):
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])


def _count_pairs(schema: pa.Schema):
    """All questions about this partition's pairs: answers by block, and the highest count per B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, held = [], []
        for b in batches:
            who += zip(b.column("block").to_pylist(), b.column("pid").to_pylist(), strict=True)
            held += [np.frombuffer(x.as_buffer(), ASK) for x in b.column("body")]
        if not held:
            return
        asks = np.concatenate(held)
        pairs, at = np.unique(asks["pair"], return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, at, asks["n"])
        ids = (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        best = np.zeros(int(ids.max()) + 1, np.int64)
        np.maximum.at(best, ids, total)
        yield pa.RecordBatch.from_pylist([{"best": best.tobytes()}], schema)
        cut = np.append(0, np.cumsum([len(x) for x in held]))
        for k in range(0, len(held), 100):
            rows = [
                {"block": who[i][0], "pid": who[i][1], "body": total[at[cut[i] : cut[i + 1]]].tobytes()}
                for i in range(k, min(k + 100, len(held)))
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _best_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for body in b.column("best"):
            best = np.frombuffer(body.as_buffer(), np.int64)
            at = np.flatnonzero(best)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(best[at])], ["id", "n"])


def _resolve(known):
    """Blocks with their answers to documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity, same_count, best = known.value
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                same, b_ids = _widen(r["same"]), _widen(r["b_ids"])
                answers = [np.frombuffer(x["body"], np.int64) for x in r["answers"] or ()]
                count = np.concatenate([same_count[same], *answers])
                highest = count == best[np.concatenate([identity[same], b_ids])]
                links, sizes, units = _widen(r["links"]), _widen(r["sizes"]), _widen(r["units"])
                unit_sum, unit_best = _sums(count[links], sizes), _sums(highest[links], sizes)
                docs = pa.ipc.open_stream(r["docs"]).read_all().combine_chunks().to_batches()[0]
                per = docs.column("units").to_numpy()
                numbers = [docs.column(x) for x in ("doc_id", "n_a", "n_b", "n_groups")]
                numbers += [pa.array(_sums(x[units], per)) for x in (sizes, unit_best, unit_sum)]
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([*numbers, docs.column("sha"), docs.column("text")], names)

    return run


def _vector(rows: DataFrame, how, length: int) -> np.ndarray:
    """One long an id of a vocabulary, on the driver."""
    out = np.zeros(length, np.int64)
    for r in rows.groupBy("id").agg(how("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """Per document: tokens, groups, links, their counts, and (with `keep_text`) the groups as text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    width = shuffle_width(spark)
    arrow = lambda ddl: to_arrow_schema(StructType.fromDDL(ddl))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = docs.mapInArrow(_blocks(a_path, b_path, width, keep_text, arrow(BLOCK_SCHEMA)), BLOCK_SCHEMA)
    blocks = materialise(blocks, "alignment-blocks")
    asks = blocks.where("block IS NOT NULL").select("block", F.explode("asks").alias("ask")).select("block", "ask.*")
    answers = asks.repartitionById(width, F.col("pid")).mapInArrow(_count_pairs(arrow(ANSWER_SCHEMA)), ANSWER_SCHEMA)
    answers = materialise(answers, "alignment-answers")
    links = unit_links(a_path, b_path)
    vectors = blocks.where("vector IS NOT NULL").select("vector").mapInArrow(_vector_counts, "id long, n long")
    same_count = _vector(vectors, F.sum, len(links.identity))
    highest = answers.where("best IS NOT NULL").select("best").mapInArrow(_best_counts, "id long, n long")
    best = _vector(highest, F.max, len(links.b.bytes))
    at = np.flatnonzero(same_count)
    np.maximum.at(best, links.identity[at], same_count[at])
    known = spark.sparkContext.broadcast((links.identity, same_count, best))
    found = (
        answers.where("block IS NOT NULL").groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("pid", "body"))).alias("answers"))
    )
    bodies = blocks.where("block IS NOT NULL").drop("asks", "vector")
    return bodies.join(found.hint("shuffle_hash"), "block", "left").mapInArrow(_resolve(known), SCHEMA)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    paths = [public_tokenizers.path(x) for x in (A_FILE, B_FILE)]
    return align_tokens(docs, *paths, keep_text=False).drop("groups")
