"""Operator 12 against brute force; the minimal perfect hash and its arrays by themselves."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from ripplecast.llm import line_dedup
from ripplecast.llm.line_dedup import LineArrays
from ripplecast.llm.perfect_hash import MinimalHash
from ripplecast.llm.tables import importable

SCHEMA = "doc_id long, text string, gone string, key string, kind int, pid int, lines string"
WHITE = " \t\n\x0b\x0c\r"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "g", "k", 1, 2, "l") for r in rows], SCHEMA).repartition(5)


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def expected(rows):
    holders = defaultdict(set)
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key_of(line)) >= 10:
                    holders[key_of(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [
            x for x in lines
            if i is None or len(holders.get(key_of(x), ())) < 2 or i == min(holders[key_of(x)])
        ]
        kept = "\n".join(stay)
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def made_up():
    rng = random.Random(6)
    pool = [f"  a shared line {k} of some length\t" for k in range(30)] + ["short", "ten chars!", "nine char", "ééééééééé", "éééééééééé", ""]
    pool += ["A SHARED LINE 3 of some length", "\x0ba shared line 4 OF some length\r", "É shared line 5", "é shared line 5", "\xa0ten chars!"]
    rows = [(i, "\n".join(rng.choices([*pool, f"own line of document {i}"], k=rng.randint(1, 12)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "\n"), (83, "a shared line 3 of some length\n" * 5), (-7, "a shared line 3 of some length\n" * 3)]
    rows += [(84, "the same words twice"), (84, "the same words twice\nanother own line"), (None, "a shared line 3 of some length"), (None, None)]
    rows += [(85, "x" * 300_000 + "\n" + "a shared line 9 of some length"), (86, "y\n" * 50_000 + "x" * 300_000)]
    return rows + [(200 + i, f"in every document at last\n{i}") for i in range(300)]


@pytest.mark.parametrize("flush", [1_000_000, 40])
def test_dedup_equals_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(line_dedup, "FLUSH_LINES", flush)
    rows = made_up()
    got = sorted((tuple(r) for r in line_dedup.line_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == expected(rows)


def test_empty_table_and_nothing_shared(spark):
    assert line_dedup.line_dedup(frame(spark, [(1, "x")]).limit(0)).collect() == []
    rows = [(i, f"all of this is document {i}") for i in range(9)]
    assert sorted((tuple(r) for r in line_dedup.line_dedup(frame(spark, rows)).collect()), key=repr) == expected(rows)


def keys(n, seed=1):
    h = np.frombuffer(random.Random(seed).randbytes(16 * n), "<u8").reshape(-1, 2)
    return h[:, 0].copy(), h[:, 1].copy()


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 50_000])
def test_slots_are_a_permutation_at_few_bits_a_key(n):
    h1, h2 = keys(n)
    hash_ = MinimalHash.build(h1, h2)
    assert np.array_equal(np.sort(hash_.slots(h1, h2)), np.arange(n)) and hash_.size == n
    again, end = MinimalHash.load(b"xxxxxxxx" + hash_.dump(), 8)
    assert np.array_equal(again.slots(h1, h2), hash_.slots(h1, h2)) and end == 8 + len(hash_.dump())
    if n >= 1000:
        assert 8 * len(hash_.dump()) < 6 * n


def test_keys_that_share_a_half_are_told_apart():
    h1, h2 = keys(500)
    a, b = np.concatenate([h1, h1, h1[:1].repeat(50)]), np.concatenate([h2, h2 + np.uint64(1), np.arange(50, dtype=np.uint64)])
    hash_ = MinimalHash.build(a, b)
    assert np.array_equal(np.sort(hash_.slots(a, b)), np.arange(1050))


def test_arrays_reject_foreign_keys_and_keep_the_least_document():
    h1, h2 = keys(2000)
    arrays = LineArrays.load(LineArrays.build(h1, h2, np.full(2000, 3), np.arange(2000, dtype=np.int64)).dump())
    known, goes = arrays.probe(h1, h2, np.arange(2000) + np.arange(2000) % 2)
    assert known.all() and np.array_equal(goes, np.arange(2000) % 2 == 1)
    known, goes = arrays.probe(*keys(100_000, 2), np.full(100_000, 2**62))
    assert not known.any() and not goes.any()
    known, goes = arrays.probe(h1, h2 + np.uint64(1), np.full(2000, 2**62))
    assert not known.any()
