"""Operator 11 against whole-text encodings and plain counting."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import public_tokenizers
import pytest

from ripplecast.llm import alignment, tokenizer_links
from ripplecast.llm.tables import importable

PATHS = [public_tokenizers.path(x) for x in (alignment.A_FILE, alignment.B_FILE)]
SCHEMA = "doc_id long, text string, units string, block long, pid int, answers string"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def byte_level():
    plain = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    out, n = {chr(x): x for x in plain}, 0
    for x in range(256):
        if x not in plain:
            out[chr(256 + n)], n = x, n + 1
    return out


ALPHABET = byte_level()


def groups_of(text, coders):
    """[(A ids, B ids)] of the groups of one text, from its whole encodings."""
    if not text:
        return []
    a, b = coders
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(ALPHABET[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return []
    out, i, j, end_a, end_b = [([], [])], 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if end_a <= end_b and i < len(ids_a):
            out[-1][0].append(ids_a[i])
            end_a, i = end_a + len(bytes_a[i]), i + 1
        else:
            out[-1][1].append(ids_b[j])
            end_b, j = end_b + len(bytes_b[j]), j + 1
        if end_a == end_b:
            out.append(([], []))
    return out[:-1]


def expected(rows, coders):
    groups = [groups_of(t, coders) for _, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for d in groups for g in d)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), d in zip(rows, groups, strict=True):
        links = [(g[0][-1], g[1][-1]) for g in d]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in d)
        out.append((
            i, sum(len(a) for a, _ in d), sum(len(b) for _, b in d), len(d), len(links),
            sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if d else "", text,
        ))
    return out


def made_up():
    rng = random.Random(5)
    odd = [
        None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "  lead", "tail  ", "a\nb", "a \n b", "a\n\n  b\n", "x\r\ny;\r\n  z\r",
        "()\r (){\r\r}", "tab\tand\t\ttabs \t x", "don't we'll I'M", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b ▁", " x   y ",
        "　你好 　 x", " a  b  ", "café ć ẞ \U0001f600\U0001f600", "é ﬁ ½", "\x00 \x01a", "12345 6789  10",
        "z" * 3000, "ab" * 2000 + " c", "!" * 700 + " ?", "\x85 q\x1c r\x1f s", "અઆ กำ नि",
    ]
    alphabet = list("abcde \n\t.,'\r") + ["  ", " \n", "é", "▁", " ", "1", "你", "'s"]
    texts = odd + ["".join(rng.choices(alphabet[:-5] if k % 2 else alphabet, k=rng.randint(1, 60))) for k in range(200)]
    words = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(1, 9))) for _ in range(400)]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 200))) for _ in range(40)]
    return list(enumerate(texts)) + [(3, "again"), (None, "no id here")]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "u", 1, 2, "x") for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in alignment.align_tokens(df, *PATHS).collect()]
    return sorted(got, key=repr)


@pytest.mark.parametrize("block", [200_000, 50])
def test_alignment_equals_plain_counting(spark, monkeypatch, coders, block):
    monkeypatch.setattr(alignment, "BLOCK_UNITS", block)
    rows = made_up()
    want = [(*r[:8], r[8]) for r in expected(rows, coders)]
    got = run(spark, rows)
    for g, w in zip(got, sorted(want, key=repr), strict=True):
        assert g == w


def test_empty_table_and_one_hot_pair(spark, coders):
    assert run(spark, [])[:0] == [] and alignment.align_tokens(spark.createDataFrame([], SCHEMA), *PATHS).collect() == []
    rows = [(i, "qzqz") for i in range(300)] + [(300, "other words")]
    assert run(spark, rows) == sorted(expected(rows, coders), key=repr)


def test_cache_is_cleared_between_blocks(coders):
    links = tokenizer_links.UnitLinks(*PATHS)
    one = links.cut(["some words here"])[0]
    before = [links.text[i] for i in one]
    links.clear()
    assert len(links) == 0
    assert [links.text[i] for i in links.cut(["some words here"])[0]] == before


def test_identity_map_joins_equal_bytes():
    links = tokenizer_links.UnitLinks(*PATHS)
    at = (links.identity >= 0).nonzero()[0]
    assert len(at) > 10_000
    assert all(links.a.bytes[i] == links.b.bytes[links.identity[i]] for i in at)
    assert links.a.ranked and "\r" in links.b.glue


def test_very_long_text(spark, coders):
    rows = [(0, "word " * 400_000), (1, "x" * 200_000)]
    assert run(spark, rows) == sorted(expected(rows, coders), key=repr)
