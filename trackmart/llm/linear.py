"""Hashed n-grams and the linear models that two operators fit on bounded samples."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_map, rows_of, written

#: Bytes of features that the driver takes at most, whatever the texts are.
SAMPLE_BYTES = 128 << 20
_ODD = 0x9E3779B97F4A7C15


def _mix(values: np.ndarray) -> np.ndarray:
    values = values * np.uint64(_ODD)
    return values ^ (values >> np.uint64(31))


def word_grams(text: str | None, size: int, buckets: int) -> np.ndarray:
    """Buckets of the word n-grams of 1 to ``size`` words, repeats included."""
    words = (text or "").encode().split()
    single = np.fromiter(map(crc32, words), np.uint64, len(words))
    out, gram = [], single
    for n in range(1, size + 1):
        if n > 1:
            gram = _mix(gram[:-1] + np.uint64(1)) + single[n - 1:]
        out.append(_mix(gram + np.uint64(n)) % np.uint64(buckets))
    return np.concatenate(out).astype(np.int32)


def char_grams(text: str | None, size: int, buckets: int) -> np.ndarray:
    """Buckets of the n-grams of exactly ``size`` code points, repeats included."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if len(codes) < size:
        return np.empty(0, np.int32)
    gram = codes[:len(codes) - size + 1]
    for n in range(1, size):
        gram = gram * np.uint64(0x100000001B3) + codes[n:len(codes) - size + 1 + n]
    return (_mix(gram + np.uint64(size << 40)) % np.uint64(buckets)).astype(np.int32)


def sample_ids(labels: DataFrame, rows: int, first: int | None = None) -> DataFrame:
    """(doc_id, label, fits): at most ``rows`` ids of either label, 0 and 1, chosen by a hash of the
    id; the first ``first`` of them, or all, are to be fitted.

    ``2 * rows`` rows at most, whatever the input.
    """
    known = labels.select("doc_id", "label").filter("doc_id is not null").distinct()
    parts = []
    for label in (0, 1):
        ordered = known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        part = ordered.limit(rows).withColumn("fits", F.lit(first is None))
        if first is not None:
            some = ordered.limit(first).select("doc_id", F.lit(True).alias("first"))
            part = part.join(F.broadcast(some), "doc_id", "left").select(
                "doc_id", "label", F.coalesce("first", "fits").alias("fits"))
        parts.append(part)
    return parts[0].unionByName(parts[1])


def sample_features(docs: DataFrame, chosen: DataFrame,
                    features: Callable[[str | None], np.ndarray]) -> DataFrame:
    """(doc_id, label, fits, h, at): features and a hash of the texts of ``chosen`` ids, stored.

    The documents are read once and not shuffled. Rows that agree in doc_id,
    text and label count once; an id with several texts has a row for each.
    """
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").distinct()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for *own, text in rows_of(batches, "doc_id", "label", "fits", "h", "text"):
            yield (*own, features(text))

    schema = "doc_id long, label int, fits boolean, h long, at array<int>"
    return written(arrow_map(marked.withColumn("h", F.xxhash64("text")), rows, schema), "features")


def collect_features(stored: DataFrame, rows: int,
                     most_bytes: int = SAMPLE_BYTES) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of at most ``rows`` rows of either label, in the order of their hash.

    No text reaches the driver, and of the features ``most_bytes`` at most: rows
    beyond either bound are left out, the last ones by the hash first.
    """
    found = []
    for label in (0, 1):
        ordered = stored.filter(F.col("label") == label).orderBy("h", "doc_id")
        sizes = ordered.limit(rows).select(F.size("at").alias("n")).toArrow().column("n").to_numpy()
        fit = int(np.searchsorted(np.cumsum(4 * sizes.astype(np.int64)), most_bytes // 2, "right"))
        table = ordered.limit(fit).select("h", "at").toArrow()
        for h, at in zip(table.column("h").to_pylist(), table.column("at")):
            found.append((h, label, at.values.to_numpy()))
    found.sort(key=lambda row: row[:2])
    return [at for _, _, at in found], np.array([label for _, label, _ in found], np.int64)


class Sigmoid:
    """Probability of a margin; its parameters come from ``fit_sigmoid``."""

    def __init__(self, slope: float, shift: float):
        self.slope, self.shift = slope, shift

    def __call__(self, margin: float) -> float:
        z = max(-700.0, min(700.0, self.slope * margin + self.shift))
        return 1.0 / (1.0 + math.exp(-z))

    def logit(self, probability: float) -> float:
        p = min(max(probability, 1e-12), 1 - 1e-12)
        return (math.log(p / (1 - p)) - self.shift) / self.slope


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray) -> Sigmoid:
    """Platt's calibration by Newton steps; without both labels, always their one value."""
    ones = int(labels.sum()) if len(labels) else 0
    if not len(labels) or ones in (0, len(labels)):
        return Sigmoid(0.0, -20.0 if len(labels) and not ones else 20.0)
    zeros = len(labels) - ones
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, shift = 1.0, math.log((ones + 1) / (zeros + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500)))
        gradient = np.array([((p - target) * margins).sum(), (p - target).sum()])
        w = np.maximum(p * (1 - p), 1e-12)
        hessian = np.array([[(w * margins ** 2).sum(), (w * margins).sum()],
                            [(w * margins).sum(), w.sum()]]) + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(hessian, gradient), -5, 5)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return Sigmoid(max(slope, 1e-3), shift)


def fit_logistic(rows: list[np.ndarray], labels: np.ndarray, buckets: int, epochs: int = 8,
                 rate: float = 0.5, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on indicator rows of unit length, by AdaGrad; both labels weigh alike."""
    weights, bias = np.zeros(buckets), 0.0
    if len(set(labels.tolist())) < 2:
        return weights, bias
    square, square_bias = np.full(buckets, 1e-8), 1e-8
    share = {1: len(labels) / (2 * labels.sum()), 0: len(labels) / (2 * (labels == 0).sum())}
    order = np.random.default_rng(9)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, y = rows[i], int(labels[i])
            value = 1 / math.sqrt(max(len(at), 1))
            z = min(max(weights[at].sum() * value + bias, -30.0), 30.0)
            slope = share[y] * (1 / (1 + math.exp(-z)) - y)
            gradient = slope * value + decay * weights[at]
            square[at] += gradient ** 2
            weights[at] -= rate * gradient / np.sqrt(square[at])
            square_bias += slope ** 2
            bias -= rate * slope / math.sqrt(square_bias)
    return weights, bias


def fit_hinge(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = 1.0,
              epochs: int = 20) -> tuple[np.ndarray, float]:
    """A linear support vector machine by dual coordinate descent.

    A row's indicators are scaled by ``scale`` and brought to unit length. The
    dual variable of one row at a time goes to its optimum between 0 and the
    cost of its label, and the weights follow.
    """
    weights, bias = np.zeros(len(scale)), 0.0
    if len(set(labels.tolist())) < 2:
        return weights, bias
    signs = np.where(labels > 0, 1.0, -1.0)
    ones = (labels > 0).sum()
    zeros = len(labels) - ones
    limits = cost * len(labels) / 2 / np.where(labels > 0, ones, zeros)
    values = []
    for at in rows:
        v = scale[at]
        values.append(v / max(float(np.sqrt((v ** 2).sum())), 1e-12))
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, v = rows[i], values[i]
            gradient = signs[i] * (weights[at] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / 2.0, 0.0), limits[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[at] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, bias
