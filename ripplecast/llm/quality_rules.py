"""Quality rules (operator 4): gradient-boosted trees over document statistics.

One vectorised pass computes the statistics of every whole text. A forest is
fitted on a bounded labelled sample (`TRAIN_ROWS`, chosen by hash of the id) and scores
all documents as flat numpy node arrays. Symbols, duplicate lines and
repeated words may only lower the score (monotonic constraints).

Defined results: null, empty or word-free text has all counts 0 and fails the
base rule (fewer than 50 words); null or repeated doc_ids are scored row by row; without
usable labels of both classes the verdict is the base rule's; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.gbt import Forest, fit_forest
from ripplecast.llm.tables import read
from ripplecast.llm.text import (
    CONTINUATION,
    SEPARATOR,
    Chunk,
    byte_symbols,
    chunks,
    gram_hash,
    mix,
    prefix_sums,
    span_hash,
    split_words,
    word_hashes,
)

TRAIN_ROWS = 20_000
KEEP_ABOVE = 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STOP = np.zeros(256, bool)
STOP[list(b".!?")] = True

FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeat_words",
    "line_words", "distinct_words", "upper", "digits", "stops",
)
#: The score may only fall as these rise.
MONOTONE = np.array([-1 if f in ("symbols", "dup_lines", "repeat_words") else 0 for f in FEATURES])

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double"
)


def _per_row(flags: np.ndarray, c: Chunk) -> np.ndarray:
    cum = np.append(0, np.cumsum(flags))
    return cum[c.ends] - cum[c.starts]


def _repeated(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Flags: the value occurs elsewhere in the same row too. `row` is sorted."""
    order = np.lexsort((value, row)) if len(row) and row[-1] >= 1 << 14 else np.argsort(
        (row.astype(np.uint64) << np.uint64(50)) | (value >> np.uint64(14)), kind="stable"
    )
    same = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(row), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def statistics(c: Chunk) -> dict[str, np.ndarray]:
    """The contract's counts and the features of every row of a chunk."""
    rows = len(c.ids)
    words = split_words(c.buf, c.starts, c.ends)
    hashed, of = word_hashes(c.buf, words), words.row()
    n = words.count
    word_chars = _per_row(~SEPARATOR[c.buf] & ~CONTINUATION[c.buf], c)

    grams = gram_hash(prefix_sums(hashed), 3)
    count = np.maximum(n - 2, 0)
    gram_row = np.repeat(np.arange(rows), count)
    at = np.arange(len(gram_row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(words.first, count)
    again = at[_repeated(gram_row, mix(grams[at]))]
    covered = np.zeros(len(hashed), bool)
    for k in range(3):
        covered[again + k] = True

    # Lines: cut at \n and at row borders; one counts if it holds a word.
    breaks = np.flatnonzero(c.buf == 10)
    begin = np.sort(np.concatenate([c.starts, breaks + 1]))
    line_row = np.concatenate([np.arange(rows), np.searchsorted(c.starts, breaks, "right") - 1])
    line_row.sort()
    stop = np.sort(np.concatenate([c.ends, breaks]))
    holds = np.searchsorted(words.start, stop) > np.searchsorted(words.start, begin)
    begin, stop, line_row = begin[holds], stop[holds], line_row[holds]
    line = mix(span_hash(prefix_sums(byte_symbols(c.buf)), begin, stop) ^ (stop - begin).astype(np.uint64))
    order = np.lexsort((line, line_row))
    dup = (line_row[order][1:] == line_row[order][:-1]) & (line[order][1:] == line[order][:-1])
    lines = np.bincount(line_row, minlength=rows)
    n_dup = np.bincount(line_row[order][1:][dup], minlength=rows)

    sort = np.sort((of.astype(np.uint64) << np.uint64(50)) | (hashed >> np.uint64(14)))
    new = np.ones(len(sort), bool)
    new[1:] = sort[1:] != sort[:-1]
    distinct = np.bincount((sort[new] >> np.uint64(50)).astype(np.int64), minlength=rows)

    n_symbols = _per_row(SYMBOL[c.buf], c)
    n_repeat = np.bincount(of[covered], minlength=rows)
    per_word, per_char = np.maximum(n, 1), np.maximum(word_chars, 1)
    features = (
        np.log1p(n), word_chars / per_word, n_symbols / per_word, n_dup / np.maximum(lines, 1), n_repeat / per_word,
        n / np.maximum(lines, 1), distinct / per_word, _per_row(UPPER[c.buf], c) / per_char,
        _per_row(DIGIT[c.buf], c) / per_char, _per_row(STOP[c.buf], c) / per_word,
    )
    return {
        "n_words": n, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat, "features": np.stack(features, 1),
    }


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        x = statistics(c)["features"]
        yield pa.RecordBatch.from_arrays([c.table.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])


def _score(forest: Forest | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            s = statistics(c)
            failed, kept, score = _verdict(forest, s)
            counts = [s[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            cols = [c.table.column("doc_id"), *(pa.array(x, pa.int64()) for x in counts)]
            cols += [pa.array(failed), pa.array(kept), pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def _verdict(forest: Forest | None, features: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, kept, score."""
    n = features["n_words"]
    failed = (n < 50) | (100 * features["n_repeat_words"] > 50 * n)
    score = np.ones(len(n)) if forest is None else forest.probability(features["features"])
    return failed, ~failed & (score >= KEEP_ABOVE), score


def _filter(forest: Forest | None, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, id_col, text_col):
            yield c.table.filter(pa.array(_verdict(forest, statistics(c))[1]))

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Forest | None:
    """The forest of a bounded labelled sample; None without both classes."""
    from ripplecast.llm.training import labelled_sample

    sample = labelled_sample(docs, labels, "quality", rows).mapInArrow(_training, "y double, x array<double>").toPandas()
    if sample["y"].nunique() < 2:
        return None
    sample = sample.sort_values("y", kind="stable")
    x, y = np.array(sample["x"].tolist()), sample["y"].to_numpy()
    order = np.lexsort((*x.T, y))  # the same forest whatever order the rows arrive in
    return fit_forest(x[order], y[order], MONOTONE)


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """The statistics of every document, the base rule and the verdict."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    forest = fit_quality(docs, labels.select("doc_id", "quality"), train_rows)
    return docs.mapInArrow(_score(forest), SCHEMA)


def keep_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    forest = fit_quality(texts, labels.select("doc_id", "quality"), train_rows)
    return docs.mapInArrow(_filter(forest, id_col, text_col), docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
