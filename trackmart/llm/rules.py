"""Quality rules: text statistics and a calibrated classifier (operator 9).

Fixed rules look at the words, lines and windows of the whole text. What they
let through is judged by a logistic regression on hashed words and character
n-grams, trained on labelled rows and calibrated on labelled rows kept from
the training, and scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_map, held_out, map_batches, rows_of, small_batches
from trackmart.llm.linear import (Sigmoid, char_grams, collect_features, fit_logistic,
                                  fit_sigmoid, sample_features, sample_ids, word_grams)

BUCKETS = 1 << 18
#: Documents whose calibrated probability of quality 1 is lower are rejected.
THRESHOLD = 0.2
#: Labelled rows of either label that are fitted, and as many that calibrate.
FIT_ROWS = 3_000
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    data = (text or "").encode()
    words = data.split()
    codes = np.frombuffer(data, np.uint8)
    # Code points start at bytes other than 10xxxxxx.
    chars = int(np.count_nonzero((codes & 0xC0 != 0x80) & ~_SPACE[codes]))
    symbols = int(np.count_nonzero(_SYMBOL[codes]))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words in windows of ``size`` words that occur twice or more, the first one included."""
    count = len(words) - size + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return 0
    # Names of windows, exact: those of two words, of four, of all five.
    names, have = ids, 1
    while have < size:
        step = min(have, size - have)
        pair = names[:len(words) - have - step + 1] * len(words) + names[step:][
            :len(words) - have - step + 1]
        _, names, times = np.unique(pair, return_inverse=True, return_counts=True)
        have += step
        if times.max() < 2:
            return 0
    at = np.flatnonzero(times[names] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + size, -1)
    return int(np.count_nonzero(np.cumsum(covered)))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


def features(text: str | None) -> np.ndarray:
    """Distinct hashed words and character 3-grams."""
    return np.unique(np.concatenate([word_grams(text, 1, BUCKETS), char_grams(text, 3, BUCKETS)]))


class QualityModel:
    """Weights of hashed features with a calibration; without both labels it accepts everything."""

    def __init__(self, weights: np.ndarray, bias: float, sigmoid: Sigmoid):
        self.weights, self.bias, self.sigmoid = weights.astype(np.float32), bias, sigmoid

    def probability(self, found: np.ndarray) -> float:
        """Of a text's features."""
        norm = np.sqrt(max(len(found), 1))
        return self.sigmoid(float(self.weights[found].sum()) / norm + self.bias)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """A model of ``labels`` (doc_id, quality).

    At most ``fit_rows`` rows of either label are fitted and as many others
    calibrate; which ones, a hash of the doc_id decides. Rows whose label is
    null do not count. The documents are read once and no text reaches the
    driver, see ``collect_features``.
    """
    known = labels.filter("quality in (0, 1)").select("doc_id", F.col("quality").alias("label"))
    apart = held_out(F.col("doc_id"))
    ids = sample_ids(known.filter(~apart), fit_rows).unionByName(
        sample_ids(known.filter(apart), fit_rows))
    stored = sample_features(docs, ids, features)
    train = collect_features(stored.filter(~apart), fit_rows)
    rest = collect_features(stored.filter(apart), fit_rows)
    weights, bias = fit_logistic(*train, BUCKETS)
    plain = QualityModel(weights, bias, Sigmoid(1.0, 0.0))
    rows, wanted = rest if len(set(rest[1].tolist())) == 2 else train
    margins = np.array([plain.sigmoid.logit(plain.probability(at)) for at in rows])
    return QualityModel(weights, bias, fit_sigmoid(margins, wanted))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Statistics and verdict of every document.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, probability, kept. A null text has no words
    and fails. Texts are judged whole, however long. Other columns of ``docs`` are ignored; repeated rows are judged
    alike. Empty in, empty out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(fit_quality(docs, labels))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        quality = model.value
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            found = statistics(text)
            failed = base_failed(found[0], found[4])
            probability = quality.probability(features(text))
            yield (doc_id, *found, failed, probability, not failed and probability >= threshold)

    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, base_failed boolean, probability double, kept boolean")
    return arrow_map(docs.select("doc_id", "text"), rows, schema, batch_rows=5000)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    The verdict is taken where the row is read, on the whole text: nothing is
    shuffled. A null or empty text has no words and goes; repeated rows stay or
    go together. Empty in, empty out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(fit_quality(docs, labels))

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quality = model.value
        for batch in batches:
            verdict = []
            for text in batch.column("text").to_pylist():
                found = statistics(text)
                verdict.append(not base_failed(found[0], found[4])
                               and quality.probability(features(text)) >= threshold)
            yield batch.filter(pa.array(verdict, pa.bool_()))

    return map_batches(docs, good, docs.schema)
