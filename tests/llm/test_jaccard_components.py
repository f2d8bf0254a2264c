"""Components of several blocks: a line of many documents does not bring them together, and no link is lost."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ripplecast.llm import jaccard_join
from ripplecast.llm.tables import importable
from tests.llm.test_operators import by_id, classes

LINE = "this line of some twenty words stands in every one of these documents and ties them all by its shingles"


def corpus(n: int = 240) -> list[tuple]:
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    texts = []
    for i in range(n):
        if i % 12 == 11:  # a near copy
            w = texts[rng.randrange(len(texts))].split(" ")
            w[-1] = rng.choice(words)
            texts.append(" ".join(w))
        else:
            body = rng.choices(words, k=rng.choice((8, 30, 60, 61, 62)))
            texts.append(" ".join(body[:5]) + " " + LINE + " " + " ".join(body[5:]))
    return [*enumerate(texts), (n, None), (n + 1, ""), (n + 2, "the " * 40), (n + 3, "the " * 30), (n + 4, texts[3])]


@pytest.mark.parametrize("block", [20, 4])
def test_a_common_line_does_not_tie_all_documents(spark, monkeypatch, block):
    importable(spark)
    rows, seen, clusters = corpus(), [], jaccard_join._clusters

    def watched(sets, *args):
        before = sets.groupBy("comp").count().collect()
        seen.append(max(r["count"] for r in before))
        return clusters(sets, *args)

    monkeypatch.setattr(jaccard_join, "_clusters", watched)
    df = spark.createDataFrame([*rows, (None, rows[0][1]), rows[5]], "doc_id long, text string").repartition(5)
    got = by_id(jaccard_join.jaccard_classes(df, block_docs=block))
    assert got.pop(None)["component_id"] is None
    want = classes(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert len({c for _, c in want.values()}) < len(rows) - 10
    assert seen[0] < 60  # the line tied more than half of the documents


def test_linked_sets_share_a_key_in_any_order_of_shingles():
    rng = np.random.default_rng(6)
    for size in (6, 20, 31, 40, 90, 400):
        for _ in range(30):
            base = rng.integers(0, 1 << 50, size).astype(np.uint64)
            drop = int(rng.integers(0, max(2, size // 9)))
            more = rng.integers(0, 1 << 50, int(rng.integers(0, max(2, size // 9)))).astype(np.uint64)
            pair = [np.unique(base), np.unique(np.concatenate([base[drop:], more]))]
            both = len(np.intersect1d(*pair))
            row, value = np.repeat([0, 1], [len(x) for x in pair]), np.concatenate(pair)
            common = np.where(value % np.uint64(int(rng.integers(2, 6))) == 0, (value % np.uint64(97)).astype(np.int64), 0)
            if 100 * both >= 80 * len(np.union1d(*pair)):
                of, key = jaccard_join.candidate_keys(row, value, 2, 80, common)
                assert np.intersect1d(key[of == 0], key[of == 1]).size
