"""Quality classifier: naive Bayes support vectors (operator 7).

Indicators of hashed word n-grams are scaled by the log ratio of their counts
in the two classes, counted over the labelled training rows of at most
``COUNT_ROWS`` ids of either label, and a linear hinge-loss model is fitted on
them by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_map, held_out, rows_of, small_batches
from trackmart.llm.linear import (Sigmoid, char_grams, collect_features, fit_hinge, fit_sigmoid,
                                  sample_features, sample_ids, word_grams)

BUCKETS = 1 << 17
#: Labelled training rows of either label whose features are counted.
COUNT_ROWS = 20_000
#: Those of them that the hinge loss is fitted on, a quarter of which calibrate.
FIT_ROWS = 3_000


def indicators(text: str | None) -> np.ndarray:
    """Distinct hashed words, word pairs and character 4-grams."""
    return np.unique(np.concatenate([word_grams(text, 2, BUCKETS), char_grams(text, 4, BUCKETS)]))


def log_count_ratios(stored: DataFrame) -> np.ndarray:
    """log((documents of label 1 with a feature + 1) / (those of label 0 + 1)), shares of each class.

    Counted over ``stored`` features (label, at); at most two numbers for each
    bucket reach the driver, whatever the input.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for label, at in zip(batch.column("label").to_pylist(), batch.column("at")):
                totals[label, at.values.to_numpy()] += 1
        for label in (0, 1):
            at = np.flatnonzero(totals[label])
            yield from zip([label] * len(at), at.tolist(), totals[label, at].tolist())

    counted = arrow_map(stored.select("label", "at"), count, "label int, bucket int, n long",
                        batch_rows=50_000)
    table = np.ones((2, BUCKETS))
    wide = counted.groupBy("bucket").agg(
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("zero"),
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("one"))
    found = wide.toArrow()
    at = found.column("bucket").to_numpy()
    table[0, at] += found.column("zero").to_numpy()
    table[1, at] += found.column("one").to_numpy()
    return np.log(table[1] / table[1].sum()) - np.log(table[0] / table[0].sum())


class NaiveBayesSupport:
    """Weights of the indicators: support vector weights times log count ratios, and a calibration."""

    def __init__(self, scale: np.ndarray, weights: np.ndarray, bias: float, sigmoid: Sigmoid):
        self.scale, self.bias, self.sigmoid = scale.astype(np.float32), bias, sigmoid
        self.weights = weights.astype(np.float32)

    def margin(self, at: np.ndarray) -> float:
        """Of a text's indicators."""
        scaled = self.scale[at]
        length = max(float(np.sqrt((scaled ** 2).sum())), 1e-12)
        return float(scaled @ self.weights[at]) / length + self.bias

    def score(self, text: str | None) -> float:
        return self.sigmoid(self.margin(indicators(text)))


def fit_quality(docs: DataFrame, labels: DataFrame, count_rows: int = COUNT_ROWS,
                fit_rows: int = FIT_ROWS) -> NaiveBayesSupport:
    """A model of a bounded sample of the training rows of ``labels`` (doc_id, quality).

    The ratios are counted over at most ``count_rows`` rows of either label.
    Of at most ``fit_rows`` of either, three quarters fit the hinge loss and
    the others calibrate. Hashes decide which. The documents are read once and
    no text reaches the driver, see ``collect_features``. With one label only, the score
    is that label's; without labels it is 1.
    """
    known = labels.filter("quality in (0, 1)").select("doc_id", F.col("quality").alias("label"))
    known = known.filter(~held_out(F.col("doc_id")))
    stored = sample_features(docs, sample_ids(known, count_rows, fit_rows), indicators)
    scale = log_count_ratios(stored)
    rows, wanted = collect_features(stored.filter("fits"), fit_rows)
    calibrates = np.arange(len(rows)) % 4 == 0
    if len(set(wanted[~calibrates].tolist())) < 2 or len(set(wanted[calibrates].tolist())) < 2:
        calibrates = np.zeros(len(rows), bool)
    fit_at = np.flatnonzero(~calibrates)
    weights, bias = fit_hinge([rows[i] for i in fit_at], wanted[fit_at], scale)
    plain = NaiveBayesSupport(scale, weights, bias, Sigmoid(1.0, 0.0))
    held = np.flatnonzero(calibrates) if calibrates.any() else np.arange(len(rows))
    margins = np.array([plain.margin(rows[i]) for i in held])
    return NaiveBayesSupport(scale, weights, bias, fit_sigmoid(margins, wanted[held]))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    The score looks at the text alone, whole, however long; a null or empty
    text has that of the bias. Other columns of ``docs`` are ignored, repeated rows score alike.
    Empty in, empty out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(fit_quality(docs, labels))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        fitted = model.value
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            score = fitted.score(text)
            yield doc_id, score, int(score >= 0.5)

    scored = arrow_map(docs.select("doc_id", "text"), rows,
                       "doc_id long, score double, predicted int", batch_rows=10_000)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         "predicted")
