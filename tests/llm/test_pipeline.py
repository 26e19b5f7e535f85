"""The queries of the subpackage against their SQL, and the stages against plain Python."""

import hashlib

import corpus_pipeline
import pytest
from common_rows import awkward, empty
from oracle import compare, connect
from test_simhash import plain_components, plain_fingerprint

from trackmart.llm import rules, simhash
from trackmart.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(DATA), QUERIES[name], ORACLES[name], DATA) is None


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "mix_sources", "encode_pieces"]


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        out = stages[name](spark, rows, DATA)
        return spark.createDataFrame(out.toArrow()) if out.columns == docs.columns else out

    good = run("quality_rules", docs)
    marks = spark.read.parquet(f"{DATA}/labels.parquet")
    verdict = {r["doc_id"] for r in rules.judge(docs, marks).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == verdict

    single = run("exact_dedup", good)
    keep = {}
    for row in good.collect():
        key = hashlib.sha256(row["text"].encode().lower() if row["text"].isascii()
                             else row["text"].encode().translate(simhash.FOLD)).hexdigest()
        keep[key] = max(row["doc_id"], keep.get(key, -1))
    assert {r["doc_id"] for r in single.collect()} == set(keep.values())

    near = run("near_dedup", single)
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in single.collect()]
    assert {r["doc_id"] for r in near.collect()} == set(plain_components(rows))

    mixed = run("mix_sources", near)
    assert mixed.columns == docs.columns
    encoded = run("encode_pieces", mixed)
    assert encoded.count() == mixed.count() and encoded.filter("not text_back").count() == 0


@pytest.mark.parametrize("rows", [awkward, empty])
def test_stages_take_any_rows(spark, rows):
    docs = rows(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() <= 2 * docs.count(), name
        if name != "encode_pieces":
            assert out.columns == docs.columns, name
