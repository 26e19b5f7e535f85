"""Operator 8: mixing sources to target weights."""

import contextlib
import io
import random
from collections import defaultdict

import pytest
from common_rows import awkward, empty
from pyspark.sql import functions as F

from trackmart.llm import mixing


def plain_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0):
    """Share by weight, stop the full sources, share their excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            target[s] = most * sizes[s]
        open_ -= set(full)
        left -= sum(target[s] for s in full)
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_the_plain_form(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}é"[: draw.randint(1, 4)] + str(i): draw.choice([0, 1, 5, 100, 10_000])
             for i in range(draw.randint(1, 9))}
    sizes[None] = draw.randint(0, 1000)
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for source in want:
        assert got[source] == pytest.approx(want[source], abs=1e-6)


def test_the_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = mixing.mix(docs, stretch=300).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()
    again = mixing.mix(docs.repartition(7), stretch=300).select("doc_id", "copies").collect()
    assert sorted((r["doc_id"], r["copies"]) for r in found) == sorted(map(tuple, again))
    taken, target = defaultdict(int), {}
    for row in found:
        assert row["taken"] == row["copies"] * row["size"] and 0 <= row["copies"] <= 2
        taken[row["source"]] += row["taken"]
        target[row["source"]] = row["target"]
    for source in target:
        assert taken[source] == pytest.approx(target[source], rel=0.05)


def test_copies_are_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    rows = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert rows == {d: n for d, n in copies.items() if n}


def test_no_python_runs(spark):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        mixing.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain()
    assert not any(word in text.getvalue() for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_awkward_rows_and_none(spark):
    docs = awkward(spark)
    found = mixing.mix(docs).collect()
    assert len(found) == 11
    assert all(r["size"] == 0 and r["taken"] == 0 for r in found if r["doc_id"] in (3, 4, 5))
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
