"""Quality classifier (operator 2): support vectors over Naive Bayes scaled n-gram indicators.

Features of a text are the distinct byte n-grams (n = 2, 3) of the text and the distinct
byte n-grams that come back at least `AGAIN` times, hashed into 2**18 buckets.
Each indicator is scaled by the log ratio of its smoothed class counts, rows are
brought to unit length, and a linear hinge-loss model is fitted by dual coordinate
descent. Margins of held-back folds give the logistic map to a score.

Fitting uses at most `TRAIN_ROWS` labelled rows, chosen by hash of their id among
those whose crc32 remainder is not the held-out one; doc_id, source, lang and labels
never enter a score. Scoring is one pass over all whole texts.

Defined results: null or empty text has no indicator and gets the intercept's score;
null or repeated doc_ids are scored row by row (a null id is not held out); without usable labels of
both classes every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.gbt import sigmoid
from ripplecast.llm.tables import read
from ripplecast.llm.text import Chunk, chunks
from ripplecast.llm.training import labelled_sample, remainder

BUCKETS = 1 << 18
TRAIN_ROWS = 6_000
#: Times an n-gram has to occur for its second indicator.
AGAIN = 4
KEEP_FROM = 0.7
GRAMS = (2, 3)


def indicators(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every indicator of a chunk, sorted by row."""
    buf, n, parts = c.buf.astype(np.uint32), len(c.buf), []
    row_of = np.repeat(np.arange(len(c.ids), dtype=np.uint64), c.ends - c.starts)
    end_of = np.repeat(c.ends, c.ends - c.starts)
    for k in GRAMS:
        if n < k:
            continue
        gram = np.full(n - k + 1, k, np.uint32)
        for j in range(k):
            gram = (gram << np.uint32(8)) | buf[j : n - k + 1 + j]
        bucket = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 17)
        inside = np.arange(n - k + 1) + k <= end_of[: n - k + 1]
        parts.append(((row_of[: n - k + 1] << np.uint64(18)) | bucket)[inside])
    packed = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    new = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(packed)))
    first = packed[new]
    both = np.concatenate([first, first[count >= AGAIN] | np.uint64(1 << 17)])
    both.sort()
    return (both >> np.uint64(18)).astype(np.int64), (both & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # float32: log-count ratio times the linear weight
    square: np.ndarray  # float32: squared ratio, for the row length
    bias: float
    slope: float
    offset: float

    def margin(self, row: np.ndarray, bucket: np.ndarray, rows: int) -> np.ndarray:
        dot = np.bincount(row, self.weight[bucket], rows)
        length = np.sqrt(np.bincount(row, self.square[bucket], rows))
        return dot / np.maximum(length, 1e-9) + self.bias

    def score(self, row: np.ndarray, bucket: np.ndarray, rows: int) -> np.ndarray:
        return sigmoid(self.slope * self.margin(row, bucket, rows) + self.offset)


def log_count_ratios(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    positive = y[row] > 0
    p = alpha + np.bincount(bucket[positive], minlength=BUCKETS)
    q = alpha + np.bincount(bucket[~positive], minlength=BUCKETS)
    n_pos, n_neg = (y > 0).sum() + 2 * alpha, (y <= 0).sum() + 2 * alpha
    return np.log(p / n_pos) - np.log(q / n_neg)


def fit_linear(
    row: np.ndarray, bucket: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 20, seed: int = 1
) -> tuple[np.ndarray, np.ndarray, float]:
    """Dual coordinate descent for hinge loss on ratio-scaled, unit-length rows. y is +1 / -1.

    One coordinate is a row's dual variable: the exact minimum along it, clipped to
    [0, C of its class] (classes weigh alike), updates the weights by that row alone.
    """
    ratio = log_count_ratios(row, bucket, y)
    cut = np.searchsorted(row, np.arange(len(y) + 1))
    value = ratio[bucket]
    length = np.sqrt(np.maximum(np.bincount(row, value**2, len(y)), 1e-12))
    value = value / length[row]
    box = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y <= 0).sum())))
    alpha, w, bias = np.zeros(len(y)), np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            b, v = bucket[cut[i] : cut[i + 1]], value[cut[i] : cut[i + 1]]
            gradient = y[i] * (w[b] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / 2.0, 0.0), box[i])  # |x|^2 = 1, and 1 for the bias
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[b] += step * v  # the buckets of a row are distinct
                bias += step
                worst, alpha[i] = max(worst, abs(step)), new
        if worst < 1e-3:
            break
    return ratio, w, bias


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic map, by Newton steps on smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, beta = np.stack([margin, np.ones(len(y))], 1), np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ beta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit_model(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, folds: int = 3) -> Model:
    """Fit on all rows; the logistic map on margins of folds that did not see them."""

    def model(rows: np.ndarray) -> Model:
        place = np.full(len(y), -1)
        place[rows] = np.arange(len(rows))
        keep = place[row] >= 0
        ratio, w, bias = fit_linear(place[row[keep]], bucket[keep], y[rows])
        return Model((ratio * w).astype(np.float32), (ratio**2).astype(np.float32), bias, 1.0, 0.0)

    margin = np.zeros(len(y))
    for f in range(folds):
        out = np.arange(len(y)) % folds == f
        margin[out] = model(np.flatnonzero(~out)).margin(row, bucket, len(y))[out]
    whole = model(np.arange(len(y)))
    return Model(whole.weight, whole.square, whole.bias, *_platt(margin, y))


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        row, bucket = indicators(c)
        cut = np.searchsorted(row, np.arange(len(c.ids) + 1))
        body = [bucket[a:b].astype("<u4").tobytes() for a, b in zip(cut, cut[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([c.table.column("doc_id"), c.table.column("y"), pa.array(body, pa.binary())], ["doc_id", "y", "x"])


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            n = len(c.ids)
            score = np.full(n, 0.5) if model is None else model.score(*indicators(c), n)
            yield pa.RecordBatch.from_arrays(
                [c.table.column("doc_id"), c.table.column("held_out"), pa.array(score), pa.array((score >= KEEP_FROM).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return run


def classify_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """Per document: held_out, score (0 to 1) and predicted class."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = labelled_sample(docs, labels.select("doc_id", "quality"), "quality", train_rows, remainder(4) != 2)
    sample = sample.mapInArrow(_training, "doc_id long, y double, x binary").toPandas().sort_values("doc_id")
    model = None
    if sample["y"].nunique() == 2:
        x = [np.frombuffer(b, "<u4") for b in sample["x"]]
        row = np.repeat(np.arange(len(x)), [len(b) for b in x])
        model = fit_model(row, np.concatenate(x).astype(np.int64), np.where(sample["y"].to_numpy() > 0, 1.0, -1.0))
    held = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return docs.select("doc_id", "text", held).mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int"
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
