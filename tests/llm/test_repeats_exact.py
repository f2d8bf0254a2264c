"""Content keys and hot windows of the repeat search: nothing goes that does not repeat."""

from __future__ import annotations

import dataclasses
import random

import numpy as np
import pyarrow as pa
import pytest

from ripplecast.llm import lpf_dedup, repeats
from ripplecast.llm.tables import importable
from ripplecast.llm.text import chunks, prefix_sums, mix

ANCHOR = "this line is in every document .."


def documents(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return ["".join(rng.choices(letters, k=67)) + ANCHOR + "".join(rng.choices(letters, k=67)) for _ in range(n)]


def test_different_contents_of_one_anchor_have_different_keys():
    """A third of these keys' bits would make some of 60,000 different contents equal."""
    texts = documents(60_000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    keys, same_anchor = [], 0
    for c in chunks(iter([batch])):
        sym = lpf_dedup._symbols(c)
        sums, others = prefix_sums(sym.hashed), prefix_sums(mix(sym.hashed, 51))
        row, _, _, akey, ckey, more = repeats.super_windows(sums, others, sym.first, sym.last, 100, 33)
        keys.append(np.stack([akey, ckey, more], axis=1))
        same_anchor += len(akey) - len(np.unique(akey))
    keys = np.concatenate(keys)
    assert len(np.unique(keys, axis=0)) == len(keys) and len(np.unique(keys[:, 1])) == len(keys)
    assert same_anchor > 1000  # many share an anchor, so only their contents tell them apart
    assert len(np.unique(keys[:, 1] >> np.uint64(32))) < len(keys)


def test_hot_windows_with_one_hash_are_compared():
    """Three windows under one key: a repeat, and one that only shares the hash."""
    rows = np.zeros(3, repeats.PART)
    rows["akey"], rows["doc"], rows["n"], rows["symbols"] = 7, [1, 2, 3], 1, 4
    values = np.frombuffer(b"abcdabcdabcx", np.uint8)
    out = repeats._flush_parts([], [(rows, values)], lpf_dedup.scheme(4), 2, 0)
    marks = np.concatenate([np.frombuffer(body, repeats.MARK) for _, kind, body in out if kind == 1])
    assert marks["doc"].tolist() == [2]
    sent = [body for _, kind, body in out if kind == 0]
    size = int.from_bytes(sent[0][:8], "little")
    assert np.frombuffer(sent[0], repeats.PART, size // repeats.PART.itemsize, 8)["doc"].tolist() == [1, 3]


def test_one_line_in_all_documents_removes_nothing_else(spark):
    importable(spark)
    texts = documents(4000)
    df = spark.createDataFrame(list(enumerate(texts)) + [(4000, texts[17])], "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r["n_removed"] for r in lpf_dedup.suffix_dedup(df, keep_text=False).collect()}
    assert got.pop(4000) == 167 and set(got.values()) == {0}


@pytest.mark.parametrize("step", [1000, 100])
def test_hot_windows_are_copied_in_slices(monkeypatch, step):
    """All windows of a chunk are sent, however few are copied at a time."""
    monkeypatch.setattr(repeats, "HOT_SYMBOLS", step)
    text = "".join(random.Random(4).choices("abcdefgh", k=900))
    kind = pa.struct([("s", pa.int64()), ("e", pa.int64()), ("akey", pa.int64()), ("flag", pa.int32())])
    edges = pa.array([[{"s": 0, "e": 900, "akey": 5, "flag": repeats.HOT}]], pa.list_(kind))
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([text]), edges], ["doc_id", "text", "edges"])
    places = []
    for out in repeats._map_contents(lpf_dedup.scheme(20), 4)(iter([batch])):
        for kind, body in zip(out.column("kind").to_pylist(), out.column("body").to_pylist(), strict=True):
            assert kind == 0
            size = int.from_bytes(body[:8], "little")
            places += np.frombuffer(body, repeats.PART, size // repeats.PART.itemsize, 8)["s"].tolist()
    assert sorted(places) == list(range(881))


def found_marks(texts: list[str], window: int, width: int = 3, cut: int = 7) -> list[tuple]:
    """The marks of the first two steps over `texts`, mapped by `cut` texts a task."""
    column = lambda name, rows: [x for b in rows for x in b.column(name).to_pylist()]
    sent = []
    for a in range(0, len(texts), cut):
        part = texts[a : a + cut]
        batch = pa.RecordBatch.from_arrays([pa.array(range(a, a + len(part)), pa.int64()), pa.array(part)], ["doc_id", "text"])
        sent += repeats._map_super_windows(lpf_dedup.scheme(window), width)(iter([batch]))
    rows = list(zip(*(column(x, sent) for x in ("pid", "kind", "body")), strict=True))
    out = []
    for p in range(width):
        blobs = repeats.blob_batch([x for x in rows if x[0] == p])
        out += list(repeats._reduce_super_windows(window)(iter([blobs])))
    return list(zip(*(column(x, out) for x in ("doc_id", "s", "e", "flag")), strict=True))


def test_windows_that_share_an_anchor_only_are_no_edges():
    """One line of an anchor's length in every document: no window repeats, so nothing is to be looked into."""
    assert found_marks(documents(25, seed=8), 100) == []


@pytest.mark.parametrize("window", [3, 4, 9, 10, 12])
def test_all_repeated_windows_are_marked(window):
    """Every window that also starts elsewhere lies in a mark, unless it is the first and only one of its content that is not removed."""
    rng = random.Random(window)
    texts = []
    for _ in range(60):
        text = "".join(rng.choices("abcdefgh", k=rng.randint(0, 60)))
        if texts and rng.random() < 0.7:  # a piece of an earlier text, at another place
            old = rng.choice(texts)
            a = rng.randint(0, len(old))
            text = text[:20] + old[a : a + rng.randint(0, 2 * window)] + text[20:]
        texts.append(text)
    marks, places = found_marks(texts, window), {}
    for d, t in enumerate(texts):
        for p in range(len(t) - window + 1):
            places.setdefault(t[p : p + window], []).append((d, p))
    inside = lambda d, p, flags: any(m[0] == d and m[1] <= p and p + window <= m[2] and m[3] in flags for m in marks)
    several = [x for x in places.values() if len(x) > 1]
    assert len(several) > 20
    for same in several:
        left = [x for x in same if not inside(*x, {repeats.REPEAT})]
        # What no mark removes is the first place, or the index gets it together with the first.
        assert same[0] in left or inside(*same[0], {repeats.REPEAT})
        if len(left) > 1:
            assert all(inside(*x, {repeats.EDGE, repeats.HOT}) for x in left)


def test_rows_alone_under_their_key_are_not_indexed():
    """Windows of hot anchors mostly are alone under their key: the index gets the others only."""
    rows = np.zeros(4, repeats.PART)
    rows["akey"], rows["doc"], rows["n"], rows["symbols"] = [7, 8, 8, 9], [1, 2, 3, 4], 1, 4
    seen = []

    def index(values, starts, counts, window):
        seen.append(len(starts))
        return lpf_dedup.scheme(4).index(values, starts, counts, window)

    scheme = dataclasses.replace(lpf_dedup.scheme(4), index=index)
    blobs = repeats._parts(rows, np.frombuffer(b"abcdxyzwxyzwijkl", np.uint8), 1, "<u1")
    out = list(repeats._reduce_contents(scheme)(iter([repeats.blob_batch(blobs)])))
    assert seen == [2] and [x for b in out for x in b.column("doc_id").to_pylist()] == [3]
