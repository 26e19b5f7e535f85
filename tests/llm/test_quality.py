"""Operators 7 and 9: the two quality models."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from common_rows import awkward, empty, labels
from pyspark.sql import functions as F

from trackmart.llm import linear, nbsvm, rules
from trackmart.llm.common import documents

DATA = "/root/testdata/sf0.01"


def given(spark):
    marks = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    return documents(spark, DATA, "doc_id", "text"), marks


def test_support_vectors_on_held_out_rows(spark):
    docs, marks = given(spark)
    found = nbsvm.score_quality(docs, marks).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in found)
    quality = {r["doc_id"]: r["quality"] for r in marks.collect()}
    held = [r for r in found if r["held_out"] and r["doc_id"] in quality]
    assert all(crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held)
    assert sum(quality[r["doc_id"]] == r["predicted"] for r in held) >= 0.95 * len(held)


def test_support_vectors_do_not_see_held_out_labels(spark):
    docs, marks = given(spark)
    spoiled = marks.selectExpr(
        "doc_id", "if(crc32(cast(string(doc_id) as binary)) % 3 = 1, 1 - quality, quality) as quality")
    assert (nbsvm.score_quality(docs, spoiled).orderBy("doc_id").collect()
            == nbsvm.score_quality(docs, marks).orderBy("doc_id").collect())


def test_dual_coordinate_descent_reaches_the_optimum():
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 30, 6)) for _ in range(80)]
    wanted = np.array([int((r < 12).sum() > 2) for r in rows])
    scale = draw.random(30) + 0.5
    weights, bias = linear.fit_hinge(rows, wanted, scale, epochs=3000)
    ones = wanted.sum()
    cost = len(rows) / 2 / np.where(wanted > 0, ones, len(rows) - ones)

    def primal(w, b):
        total = (w @ w + b * b) / 2
        for at, y, c in zip(rows, np.where(wanted > 0, 1, -1), cost):
            v = scale[at] / np.sqrt((scale[at] ** 2).sum())
            total += c * max(0, 1 - y * (w[at] @ v + b))
        return total

    best = primal(weights, bias)
    for _ in range(300):
        assert best <= primal(weights + draw.normal(0, 0.02, 30), bias + draw.normal(0, 0.02)) + 1e-2


def test_statistics_equal_the_plain_form():
    draw = random.Random(2)
    texts = [None, "", "  \n ", "a", "a b c d e a b c d e", "x\n\nx\n x\nx", "#a* é$% &|<>\n" * 3]
    for _ in range(200):
        texts.append("".join(draw.choice(["a", "b", "cc ", " ", "\n", "é ", "#"]) for _ in range(60)))
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        times = Counter(windows)
        repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert rules.statistics(text) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(repeated)), text


def test_rules_reject_junk_and_keep_clean_documents(spark):
    docs, marks = given(spark)
    found = {r["doc_id"]: r for r in rules.judge(docs, marks).collect()}
    assert len(found) == docs.count()
    clean, junk = [], []
    for row in marks.collect():
        verdict = found[row["doc_id"]]
        assert not (verdict["kept"] and verdict["base_failed"])
        if not verdict["base_failed"]:
            (clean if row["quality"] else junk).append(verdict["kept"])
    assert np.mean(clean) >= 0.98 and np.mean(junk) <= 0.2
    kept = {r["doc_id"] for r in rules.keep_good(docs, marks).collect()}
    assert kept == {d for d, r in found.items() if r["kept"]}


def test_awkward_rows_and_none(spark):
    docs = awkward(spark)
    for marks in (labels(spark), labels(spark, [(1, 1), (2, 0), (None, 1), (6, None), (7, 1), (8, 0)]),
                  labels(spark, [(1, 1)])):
        found = rules.judge(docs, marks).collect()
        assert len(found) == 11
        assert all(not r["kept"] and r["n_words"] == 0 for r in found if r["doc_id"] in (3, 4, 5))
        assert rules.keep_good(docs, marks).columns == docs.columns
        scores = nbsvm.score_quality(docs, marks).collect()
        assert len(scores) == 11 and all(0 <= r["score"] <= 1 for r in scores)
    assert rules.judge(empty(spark), labels(spark)).count() == 0
    assert nbsvm.score_quality(empty(spark), labels(spark)).count() == 0


def test_repeated_rows_of_one_label_do_not_fill_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60) for _ in range(80 if i % 2 else 1)],
                                 "doc_id long, text string")
    several = spark.createDataFrame([(1, f"other {i}") for i in range(500)], docs.schema)
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    one = lambda text: np.array([len(text)], np.int32)  # noqa: E731  (goes to the workers by value)
    for given_docs in (docs, docs.union(several)):
        stored = linear.sample_features(given_docs, linear.sample_ids(marks, 20), one)
        rows, wanted = linear.collect_features(stored, 20)
        assert Counter(wanted.tolist()) == {0: 20, 1: 20} and len(rows) == 40


def test_features_that_reach_the_driver_are_bounded(spark):
    docs = spark.createDataFrame([(i, "w " * 50) for i in range(40)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "concat(text, doc_id) as text")
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label int")
    stored = linear.sample_features(
        docs, linear.sample_ids(marks, 20), lambda text: np.arange(100, dtype=np.int32))
    assert stored.columns == ["doc_id", "label", "fits", "h", "at"]
    rows, wanted = linear.collect_features(stored, 20, most_bytes=2 * 7 * 400 + 100)
    assert Counter(wanted.tolist()) == {0: 7, 1: 7} and all(len(at) == 100 for at in rows)


def test_sampled_ids_are_the_first_by_hash_without_a_window(spark):
    marks = spark.range(300).selectExpr("id as doc_id", "cast(id % 2 as int) as label")
    sample = linear.sample_ids(marks.union(marks), 7, 3)
    assert "Window" not in sample._jdf.queryExecution().toString()
    order = [r[0] for r in marks.selectExpr("doc_id").orderBy(F.xxhash64("doc_id")).collect()]
    found = {r["doc_id"]: (r["label"], r["fits"]) for r in sample.collect()}
    want = {}
    for odd in (0, 1):
        for n, i in enumerate([i for i in order if i % 2 == odd][:7]):
            want[i] = (odd, n < 3)
    assert found == want


def test_ratios_equal_plain_counts(spark):
    docs, marks = given(spark)
    known = marks.selectExpr("doc_id", "quality as label")
    stored = linear.sample_features(docs, linear.sample_ids(known, 40), nbsvm.indicators)
    table = np.ones((2, nbsvm.BUCKETS))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in stored.select("doc_id", "label").collect():
        table[row["label"], nbsvm.indicators(texts[row["doc_id"]])] += 1
    want = np.log(table[1] / table[1].sum()) - np.log(table[0] / table[0].sum())
    assert np.allclose(nbsvm.log_count_ratios(stored), want)
    calls = docs.selectExpr("doc_id", "text", "raise_error('texts are not read') as x")
    assert linear.sample_features(calls, linear.sample_ids(known, 1), nbsvm.indicators).count() == 2
