"""Quality and toxicity classifiers: ratios, indicators, the linear fit and the dense features against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from ripplecast.llm import nbsvm, toxicity
from ripplecast.llm.text import chunks, split_words


def chunk(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    return next(iter(chunks(iter([batch]))))


# ---------------------------------------------------------------- NB-SVM
def plain_indicators(text: bytes) -> set[int]:
    out = set()
    grams = Counter()
    for k in nbsvm.GRAMS:
        for i in range(len(text) - k + 1):
            value = k
            for b in text[i : i + k]:
                value = (value << 8 | b) & 0xFFFFFFFF
            grams[((value * 0x9E3779B1) & 0xFFFFFFFF) >> 15] += 1
    for bucket, n in grams.items():
        out.add(bucket)
        if n >= nbsvm.AGAIN:
            out.add(bucket | 1 << 17)
    return out


def test_indicators_and_ratios_equal_plain_counting():
    rng = random.Random(2)
    texts = ["".join(rng.choices("abc é", k=rng.randint(0, 60))) for _ in range(40)] + ["", None, "a", "aaaaaaaa"]
    row, bucket = nbsvm.indicators(chunk(texts))
    sets = [plain_indicators((t or "").encode()) for t in texts]
    assert [set(bucket[row == i].tolist()) for i in range(len(texts))] == sets
    y = np.array([1.0 if i % 3 else -1.0 for i in range(len(texts))])
    ratio = nbsvm.log_count_ratios(row, bucket, y)
    pos, neg = (y > 0).sum() + 2, (y <= 0).sum() + 2
    for b in random.Random(3).sample(sorted(set().union(*sets)), 50):
        p, q = (1 + sum(b in s for s, v in zip(sets, y, strict=True) if (v > 0) == k) for k in (True, False))
        assert math.isclose(ratio[b], math.log(p / pos) - math.log(q / neg), abs_tol=1e-12)


def test_coordinate_descent_reaches_the_dual_optimum():
    rng = random.Random(5)
    words = {1.0: ["good", "plain", "clear"], -1.0: ["spam", "junk", "click"]}
    y = np.array([rng.choice([1.0, 1.0, -1.0]) for _ in range(60)])
    texts = [" ".join(rng.choices(words[v] + ["the", "of", "good", "junk"], k=12)) for v in y]
    row, bucket = nbsvm.indicators(chunk(texts))
    ratio, w, bias = nbsvm.fit_linear(row, bucket, y, epochs=400)
    # dense rows, scaled by the ratios to unit length, with a constant for the bias
    x = np.zeros((len(y), nbsvm.BUCKETS))
    x[row, bucket] = ratio[bucket]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    used = np.flatnonzero(np.abs(x).sum(0))
    x = np.hstack([x[:, used], np.ones((len(y), 1))])
    box = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    gram = (x @ x.T) * np.outer(y, y)
    alpha, step = np.zeros(len(y)), 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(40_000):  # projected gradient on the dual
        alpha = np.clip(alpha + step * (1 - gram @ alpha), 0, box)
    dual = alpha.sum() - alpha @ gram @ alpha / 2
    whole = np.append(w[used], bias)
    primal = whole @ whole / 2 + (box * np.maximum(0, 1 - y * (x @ whole))).sum()
    assert dual <= primal + 1e-6 and primal - dual < 0.01 * dual


# -------------------------------------------------------------- toxicity
def plain_normal(word: bytes) -> tuple[bytes, bool]:
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    out, changed = bytearray(), False
    for i, b in enumerate(word):
        between = 0 < i < len(word) - 1 and letter(word[i - 1]) and letter(word[i + 1])
        swap = toxicity.STANDS_FOR.get(chr(b)) if between else None
        if swap:
            out += swap.encode()
            changed = True
        elif letter(b) or 48 <= b <= 57:
            out.append(b + 32 if 65 <= b <= 90 else b)
        elif between:
            changed = True
    return bytes(out), changed


def plain_features(text: str, lexicon: dict[bytes, float]) -> list[float]:
    body = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", body)
    n, normal = max(1, len(words)), [plain_normal(w) for w in words]
    exact = [lexicon.get(w, 0.0) for w, _ in normal]
    # a word beginning is listed under its length: only words longer than it have it
    stem = [max([lexicon.get((w[:k], k), 0.0) for k in toxicity.STEMS if len(w) > k], default=0.0) for w, _ in normal]
    best = [max(a, b) for a, b in zip(exact, stem, strict=True)]
    person = [w.decode() in toxicity.SECOND_PERSON for w, _ in normal]
    close = sum(
        b > 0 and any(person[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i, b in enumerate(best)
    )
    hits = sum(b > 0 for b in best)
    share = lambda flags: sum(flags) / max(1, len(body))
    return [
        hits, hits / n, sum(x > 0 for x in exact) / n, sum(x > 0 for x in stem) / n, sum(best) / n, max(best, default=0.0),
        close, sum(b > 0 and c for b, (_, c) in zip(best, normal, strict=True)), share(65 <= b <= 90 for b in body),
        sum(len(w) > 1 and all(65 <= b <= 90 for b in w) for w in words) / n, share(b == 33 for b in body),
        share(b == 63 for b in body), sum(c for _, c in normal) / n,
    ]


def lexicon_arrays(lexicon):
    keys = []
    for entry in lexicon:
        body, k = entry if isinstance(entry, tuple) else (entry, None)
        data = np.frombuffer(body + (b"x" if k else b""), np.uint8)  # a beginning counts in longer words only
        normal = toxicity.normalise(data, split_words(data, np.array([0]), np.array([len(data)])))
        keys.append(normal.prefix(k)[0])
    order = np.argsort(np.array(keys, np.uint64))
    return np.array(keys, np.uint64)[order], np.array(list(lexicon.values()))[order]


def test_features_equal_plain_version():
    lexicon = {b"idiot": 3.0, b"stupid": 2.5, (b"moro", 4): 2.2, (b"losers", 6): 4.0}
    rng = random.Random(8)
    bits = ["you", "IDIOT", "id1ot!", "stu-pid", "morons", "moro", "loserssss", "the", "été", "k1", "1k", "A", "AB!", "?", "Tu", "a.b", "x@y", "\n"]
    texts = [" ".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(120)] + [None, "", "k1", "a", "b!", "c", "ab-", "ba"]
    got = toxicity.features(chunk(texts), lexicon_arrays(lexicon))
    want = np.array([plain_features(t, lexicon) for t in texts])
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_features_do_not_depend_on_the_rows_beside():
    """A sign at a row's end is not between letters, whatever the next row begins with."""
    lexicon = lexicon_arrays({b"ki": 2.0})
    alone = toxicity.features(chunk(["k1", "1k"]), lexicon)
    for beside in ("abc", "zzz", ""):
        rows = toxicity.features(chunk([beside, "k1", beside, "1k", beside]), lexicon)
        np.testing.assert_array_equal(rows[[1, 3]], alone)
