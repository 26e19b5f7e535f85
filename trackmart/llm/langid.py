"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 3)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_map, held_out, rows_of, small_batches
from trackmart.llm.linear import char_grams

BUCKETS = 1 << 14
SIZES = (1, 2, 3)
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def grams(text: str) -> np.ndarray:
    """Buckets of the 1- to 3-grams of the lower-cased text."""
    folded = text.lower()
    return np.concatenate([char_grams(folded, n, BUCKETS) for n in SIZES])


class LanguageModel:
    """Log probabilities of the buckets in each language, and of the languages."""

    def __init__(self, names: list[str], counts: np.ndarray, docs: np.ndarray):
        self.names = names
        smooth = counts + 0.5
        self.logs = np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32).copy()
        self.prior = np.log(docs / max(docs.sum(), 1))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """A language and its posterior probability for every text of a batch.

        The batch is a sparse matrix of bucket counts by text; its rows times
        the log probabilities are summed over the stretch of each text.
        """
        known = [i for i, t in enumerate(texts) if t and self.names and _LETTER.search(t)]
        out = [(UNKNOWN, 0.0)] * len(texts)
        for first in range(0, len(known), 64):
            some = known[first:first + 64]
            cells, sizes = [], []
            for i in some:
                at, n = np.unique(grams(texts[i]), return_counts=True)
                cells.append((at, n))
                sizes.append(len(at))
            at = np.concatenate([c[0] for c in cells])
            n = np.concatenate([c[1] for c in cells]).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            sums = np.add.reduceat(self.logs[at] * n[:, None], starts, axis=0) + self.prior
            sums -= sums.max(1, keepdims=True)
            share = np.exp(sums)
            share /= share.sum(1, keepdims=True)
            for row, (i, best) in enumerate(zip(some, share.argmax(1))):
                out[i] = (self.names[best], float(share[row, best]))
        return out


def fit_languages(docs: DataFrame) -> LanguageModel:
    """A model of all rows of ``docs`` (text, lang) with both; the counts are sums in Spark.

    A number for each language and bucket reaches the driver, whatever the
    input. Languages go by name, so that ties fall to the first one.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        totals: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for text, lang in rows_of(batches, "text", "lang"):
            if lang not in totals:
                totals[lang], rows[lang] = np.zeros(BUCKETS, np.int64), 0
            totals[lang] += np.bincount(grams(text), minlength=BUCKETS)
            rows[lang] += 1
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield lang, -1, rows[lang]
            yield from zip([lang] * len(at), at.tolist(), total[at].tolist())

    labelled = docs.select("text", "lang").filter("text is not null and lang is not null")
    counted = arrow_map(labelled, count, "lang string, bucket int, n long", batch_rows=50_000)
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = found.column("lang").to_pylist()
    names = sorted(set(langs))
    index = {name: i for i, name in enumerate(names)}
    table = np.zeros((len(names), BUCKETS + 1))
    rows = np.array([index[x] for x in langs], dtype=np.int64)
    table[rows, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return LanguageModel(names, table[:, :BUCKETS], np.maximum(table[:, BUCKETS], 1))


def predict_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    Rows that are not held out and have a lang are learned from; a prediction
    looks at the text alone. A null text, one without a letter, or a table to
    learn from without rows gives ``und`` with score 0. Texts are taken whole,
    however long. Other columns of
    ``docs`` are ignored; repeated rows are predicted alike. Empty in, empty
    out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fitted = fit_languages(docs.filter(~held_out(F.col("doc_id"))))
    model = spark.sparkContext.broadcast(fitted)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            found = model.value.predict(batch.column("text").to_pylist())
            for doc_id, (lang, score) in zip(batch.column("doc_id").to_pylist(), found):
                yield doc_id, lang, score

    predicted = arrow_map(docs.select("doc_id", "text"), rows,
                          "doc_id long, lang_pred string, score double", batch_rows=10_000)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                            "score")
