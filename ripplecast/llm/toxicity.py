"""Toxicity (operator 7): boosted trees over dense features, calibrated isotonically.

Words are normalised (A-Z lowered, punctuation inside and around dropped, digits
and signs standing for a letter between letters replaced). A lexicon of normalised
words and word beginnings is learnt by smoothed log odds on the training rows.
Dense features: lexicon densities, closeness of lexicon words to second-person words,
capitals, punctuation and obfuscation rates. A forest is fitted on features
whose lexicon did not see the row (five folds), and isotonic regression on
margins of folds maps its output to a probability.

Fitting uses at most `TRAIN_ROWS` labelled rows, chosen by hash of their id among
those whose crc32 remainder is not the held-out one; doc_id, source, lang and labels
never enter a score. Scoring is one pass over all whole texts.

Defined results: null or empty text has all features 0 and is scored like any other;
null or repeated doc_ids are scored row by row (a null id is not held out); without usable
labels of both classes every score is 0; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.gbt import Forest, Isotonic, fit_forest, fit_isotonic
from ripplecast.llm.tables import materialise, read
from ripplecast.llm.text import Chunk, Words, byte_symbols, chunks, mix, prefix_sums, span_hash, split_words
from ripplecast.llm.training import labelled_sample, remainder

TRAIN_ROWS = 20_000
#: Largest lexicon, least documents of an entry and least log odds.
LEXICON, SUPPORT, ODDS = 4_000, 3, 2.0
#: Bytes of the word beginnings that may enter the lexicon.
STEMS = (4, 5, 6)
TOXIC_FROM = 0.5
#: Words around a lexicon word in which a second-person word counts as close.
NEAR = 3

# Second-person words of the corpus languages.
SECOND_PERSON = (
    "you your yours yourself u ur "
    "du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros"
).split()
# Characters written for a letter.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LEET = np.zeros(256, np.uint8)
for _a, _b in STANDS_FOR.items():
    _LEET[ord(_a)] = ord(_b)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True

FEATURES = 13
FOLDS = 5
#: Documents without and with the label, per fold.
CELLS = tuple(f"{kind}{f}" for f in range(FOLDS) for kind in "nt")


@dataclass
class Normal:
    """Normalised words of a chunk."""

    sums: np.ndarray
    start: np.ndarray
    end: np.ndarray
    changed: np.ndarray  # a letter was replaced, or signs stood between letters

    def prefix(self, k: int | None = None) -> np.ndarray:
        """Hash of each word (or of its first k bytes; 0 where it is no longer than that)."""
        if k is None:
            return mix(span_hash(self.sums, self.start, self.end), 31)
        long = self.end - self.start > k
        return np.where(long, mix(span_hash(self.sums, self.start, np.where(long, self.start + k, self.end)), 31 + k), 0)


def normalise(buf: np.ndarray, words: Words) -> Normal:
    n = len(buf)
    letter = _LETTER[buf]
    near = np.zeros(n, bool)
    if n > 2:
        near[1:-1] = letter[:-2] & letter[2:]
        near[words.start], near[words.end - 1] = False, False  # the next row's text follows without a gap
    swap = near & (_LEET[buf] > 0)
    out = np.where(swap, _LEET[buf], _LOWER[buf])
    keep = letter | _DIGIT[buf] | swap
    odd = np.append(0, np.cumsum(swap | (near & ~keep)))
    cum = np.append(0, np.cumsum(keep))
    return Normal(
        prefix_sums(byte_symbols(out[keep])), cum[words.start], cum[words.end], odd[words.end] > odd[words.start]
    )


def _second_person() -> np.ndarray:
    data = np.frombuffer(" ".join(SECOND_PERSON).encode(), np.uint8)
    w = split_words(data, np.array([0]), np.array([len(data)]))
    return np.sort(normalise(data, w).prefix())


def _weights(hashes: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, odds = lexicon
    if not len(known):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, odds[at], 0.0)


def features(c: Chunk, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    rows = len(c.ids)
    words = split_words(c.buf, c.starts, c.ends)
    normal, of, n = normalise(c.buf, words), words.row(), np.maximum(words.count, 1)
    whole = normal.prefix()
    exact = _weights(whole, lexicon)
    stem = np.zeros(len(whole))
    for k in STEMS:
        stem = np.maximum(stem, _weights(normal.prefix(k), lexicon))
    best = np.maximum(exact, stem)
    hit = best > 0
    person = np.isin(whole, _second_person())
    seen = np.append(0, np.cumsum(person))
    at = np.flatnonzero(hit)
    close = seen[np.minimum(at + NEAR + 1, words.last[of[at]])] > seen[np.maximum(at - NEAR, words.first[of[at]])]

    def per_byte(flags: np.ndarray) -> np.ndarray:
        cum = np.append(0, np.cumsum(flags))
        return (cum[c.ends] - cum[c.starts]) / np.maximum(c.ends - c.starts, 1)

    add = lambda w, sel=slice(None): np.bincount(of[sel], w, rows)
    top = np.zeros(rows)
    np.maximum.at(top, of, best)
    upper = np.append(0, np.cumsum(_UPPER[c.buf]))
    shout = (upper[words.end] - upper[words.start] == words.end - words.start) & (words.end - words.start > 1)
    hits = add(hit)
    return np.stack(
        [
            hits, hits / n, add(exact > 0) / n, add(stem > 0) / n, add(best) / n, top,
            add(close, at), add(hit & normal.changed), per_byte(_UPPER[c.buf]), add(shout) / n,
            per_byte(c.buf == ord("!")), per_byte(c.buf == ord("?")), add(normal.changed) / n,
        ],
        1,
    )


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class and fold that hold a term, summed per chunk."""
    for c in chunks(batches):
        words = split_words(c.buf, c.starts, c.ends)
        normal, of = normalise(c.buf, words), words.row().astype(np.uint64)
        terms = np.concatenate([normal.prefix(), *(normal.prefix(k) for k in STEMS)])
        row = np.concatenate([of] * (1 + len(STEMS)))
        row, terms = row[terms != 0], terms[terms != 0]
        order = np.lexsort((row, terms))
        row, terms = row[order], terms[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (terms[1:] != terms[:-1])]) if len(row) else row.astype(bool)
        row, terms = row[new].astype(np.int64), terms[new]
        y, fold = (c.table.column(k).to_numpy(zero_copy_only=False) for k in ("y", "fold"))
        distinct, inverse = np.unique(terms, return_inverse=True)
        cell = (fold[row] * 2 + (y[row] > 0)).astype(np.int64)
        count = np.bincount(inverse * len(CELLS) + cell, minlength=len(CELLS) * len(distinct)).reshape(-1, len(CELLS))
        cols = [pa.array(distinct.view(np.int64)), *(pa.array(count[:, k]) for k in range(len(CELLS)))]
        yield pa.RecordBatch.from_arrays(cols, ["term", *CELLS])


def _lexicon(terms, n: np.ndarray, t: np.ndarray, rows: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    odds = np.log((t + 0.5) / (toxic + 1)) - np.log((n + 0.5) / (rows - toxic + 1))
    ok = np.flatnonzero((t >= SUPPORT) & (odds >= ODDS))
    ok = ok[np.lexsort((terms[ok], -t[ok]))][:LEXICON]
    ok = ok[np.argsort(terms[ok])]
    return terms[ok], odds[ok]


@dataclass(frozen=True)
class Model:
    lexicon: tuple[np.ndarray, np.ndarray]
    forest: Forest
    isotonic: Isotonic

    def score(self, c: Chunk) -> np.ndarray:
        return np.clip(self.isotonic(self.forest.margin(features(c, self.lexicon))), 0, 1)


def _training(lexicons):
    """Features of every row under the lexicon that did not see its fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            fold = c.table.column("fold").to_numpy(zero_copy_only=False)
            for f in np.unique(fold):
                part = c.rows(np.flatnonzero(fold == f))
                cols = [part.table.column(k) for k in ("doc_id", "y", "fold")]
                x = pa.array(list(features(part, lexicons[f])), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*cols, x], ["doc_id", "y", "fold", "x"])

    return run


#: More hits never lower the score.
MONOTONE = np.array([1] * 7 + [0] * (FEATURES - 7))


def fit_toxicity(sample: DataFrame) -> Model | None:
    """Fit on (doc_id, text, y); None without both classes."""
    sample = sample.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int"))
    size = {(r["fold"], r["y"]): r["n"] for r in sample.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    if len({y for _, y in size}) < 2:
        return None
    # Terms of the bounded sample, summed; rare ones can't enter any lexicon.
    toxic = sum(F.col(k) for k in CELLS[1::2])
    counts = (
        sample.mapInArrow(_term_counts, "term long, " + ", ".join(f"{k} long" for k in CELLS))
        .groupBy("term").agg(*(F.sum(k).alias(k) for k in CELLS))
        .where((toxic >= SUPPORT) & (toxic > sum(F.col(k) for k in CELLS[::2])))
        .toPandas().sort_values("term")
    )
    terms, cells = counts["term"].to_numpy().view(np.uint64), counts[list(CELLS)].to_numpy()
    sizes = np.array([size.get((f, y), 0) for f in range(FOLDS) for y in (0.0, 1.0)])

    def lexicon(without: int | None) -> tuple[np.ndarray, np.ndarray]:
        folds = [f for f in range(FOLDS) if f != without]
        clean, bad = [2 * f for f in folds], [2 * f + 1 for f in folds]
        return _lexicon(terms, cells[:, clean].sum(1), cells[:, bad].sum(1), sizes[clean + bad].sum(), sizes[bad].sum())

    lexicons = [lexicon(f) for f in range(FOLDS)]
    table = sample.mapInArrow(_training(lexicons), "doc_id long, y double, fold int, x array<double>").toPandas()
    table = table.sort_values("doc_id")
    x, y, fold = np.array(table["x"].tolist()), table["y"].to_numpy(), table["fold"].to_numpy()
    margin = np.zeros(len(y))
    for f in range(FOLDS):
        out = fold == f
        if out.any() and not out.all():
            margin[out] = fit_forest(x[~out], y[~out], MONOTONE).margin(x[out])
    return Model(lexicon(None), fit_forest(x, y, MONOTONE), fit_isotonic(margin, y))


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            score = np.zeros(len(c.ids)) if model is None else model.score(c)
            yield pa.RecordBatch.from_arrays(
                [c.table.column("doc_id"), c.table.column("held_out"), pa.array(score), pa.array((score >= TOXIC_FROM).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return run


def classify_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """Per document: held_out, score (0 to 1) and predicted class."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = labelled_sample(docs, labels.select("doc_id", "toxic"), "toxic", train_rows, remainder(5) != 0)
    # Copies of one text count once: their words are no evidence of their own.
    copies = sample.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    sample = copies.agg(F.min(F.struct("doc_id", "y", "text")).alias("row")).select("row.*")
    model = fit_toxicity(materialise(sample, "toxicity-sample"))
    held = F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out")
    return docs.select("doc_id", "text", held).mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
