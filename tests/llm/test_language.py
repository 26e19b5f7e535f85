"""Operator 3: language identification."""

import math
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from common_rows import awkward, empty

from trackmart.llm import langid
from trackmart.llm.common import documents


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01", "doc_id", "text", "lang")
    found = langid.predict_languages(docs).join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    held = [r for r in found if r["held_out"]]
    assert {r["held_out"] for r in found if crc32(str(r["doc_id"]).encode()) % 3 == 1} == {True}
    right = sum(r["lang_pred"] == r["lang"] for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_predictions_equal_a_plain_naive_bayes(spark):
    docs = documents(spark, "/root/testdata/sf0.001", "doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    counts, sizes = defaultdict(Counter), Counter()
    for doc_id, text, lang in rows:
        if crc32(str(doc_id).encode()) % 3 != 1 and text is not None and lang is not None:
            counts[lang].update(langid.grams(text).tolist())
            sizes[lang] += 1
    found = {r["doc_id"]: r for r in langid.predict_languages(docs).collect()}
    totals = {lang: sum(c.values()) + 0.5 * langid.BUCKETS for lang, c in counts.items()}
    for doc_id, text, _ in rows:
        got = found[doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (got["lang_pred"], got["score"]) == ("und", 0.0)
            continue
        grams = Counter(langid.grams(text).tolist())
        logs = {lang: math.log(sizes[lang] / sum(sizes.values())) + sum(
            n * math.log((counts[lang][g] + 0.5) / totals[lang]) for g, n in grams.items())
            for lang in counts}
        best = max(sorted(logs), key=logs.get)
        share = 1 / sum(math.exp(x - logs[best]) for x in logs.values())
        assert got["lang_pred"] == best and got["score"] == pytest.approx(share, abs=1e-3)


def test_equal_grams_share_a_bucket():
    text = "Ähnlich, ähnlich und ander\u0020s"
    folded = text.lower()
    plain = [folded[i:i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)]
    found = langid.grams(text).tolist()
    assert len(found) == len(plain)
    buckets = dict(zip(plain, found))
    assert [buckets[gram] for gram in plain] == found and len(set(found)) > 0.9 * len(buckets)


def test_labels_of_held_out_rows_are_not_looked_at(spark):
    docs = documents(spark, "/root/testdata/sf0.001", "doc_id", "text", "lang")
    spoiled = docs.selectExpr(
        "doc_id", "text",
        "if(crc32(cast(string(doc_id) as binary)) % 3 = 1, 'zz', lang) as lang")
    before = langid.predict_languages(docs).orderBy("doc_id").collect()
    assert langid.predict_languages(spoiled).orderBy("doc_id").collect() == before


def test_awkward_rows_and_none(spark):
    found = langid.predict_languages(awkward(spark)).collect()
    assert len(found) == 11
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in found if r["doc_id"] in (3, 4, 5))
    assert {r["lang_pred"] for r in found} <= {"en", "fr", "de", "und"}
    assert langid.predict_languages(empty(spark)).count() == 0
    nothing = awkward(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in langid.predict_languages(nothing).collect()} == {"und"}
