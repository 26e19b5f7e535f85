"""Operator 4: exact dedup by chunk recipes."""

import hashlib
import random

import pytest
from common_rows import awkward, empty
from pyspark.sql import functions as F

from trackmart.llm import exact


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_chunks_cover_the_text_and_follow_the_content():
    draw = random.Random(1)
    data = bytes(draw.getrandbits(8) for _ in range(200_000))
    ends = exact.chunk_ends(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert max(sizes) <= exact.MOST and min(sizes[:-1]) >= exact.LEAST
    moved = exact.chunk_ends(b"something before" + data)
    assert len({e - 16 for e in moved} & set(ends)) > 0.9 * len(ends)
    assert exact.chunk_ends(b"") == [] and exact.chunk_ends(b"a") == [1]
    even = exact.chunk_ends(b"a" * 100_000)
    assert max(b - a for a, b in zip([0, *even], even)) <= exact.MOST


def test_groups_equal_the_plain_form(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], fold(r["text"])) for r in docs.collect()]
    found = exact.exact_duplicates(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        text = next(t for d, t in rows if hashlib.sha256(t.encode()).hexdigest() == row["text_sha256"])
        same = [d for d, t in rows if t == text]
        known = [d for d in same if d is not None]
        assert row["group_size"] == len(same)
        assert row["keep_id"] == (max(known) if known else None)
    for text in {t for _, t in rows}:
        sha = hashlib.sha256(text.encode()).hexdigest()
        assert sum(r["kept"] for r in found if r["text_sha256"] == sha) == 1


def test_contents_with_one_hash_are_told_apart(spark):
    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "ONE"), (4, None)],
                                 "doc_id long, text string")
    number = F.when(F.col("chunk") == F.lit(b"one"), 1).otherwise(2)
    numbered = exact._numbered(docs, exact.chunk_table(docs).withColumn("number", number))
    recipes = {r["doc_id"]: bytes(r["recipe"]) for r in numbered.collect()}
    assert recipes[1] == recipes[3] != recipes[2] and recipes[4] == b""
    assert len(recipes[1]) == 24 and recipes[1][16:] == b"00000001"


def test_kept_rows_keep_their_columns(spark):
    docs = awkward(spark)
    kept = exact.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        ["2", "4", "5", "6", "7", "8", "8", "None"])
    assert exact.drop_duplicates(empty(spark)).count() == 0
    assert exact.exact_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("size", [0, 511, 512, 513, 16_384, 16_385])
def test_sizes_around_the_limits(size):
    assert (exact.chunk_ends(bytes(size)) or [0])[-1] == size
