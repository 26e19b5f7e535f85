"""Operator 1: token ids in directly addressable codes."""

import zlib

import numpy as np
import pytest
from common_rows import awkward, empty

from trackmart.llm import tokens
from trackmart.session import scratch_path


@pytest.mark.parametrize("ids", [
    [], [0], [255, 256, 65535, 65536, 2**32 - 1, 7], list(range(0, 200_000, 37)), [300] * 2000,
])
def test_any_position_is_read_alone(ids):
    ids = np.array(ids, dtype=np.uint32)
    segment = tokens.Segment(*tokens.pack(ids))
    assert len(segment) == len(ids)
    assert segment.access(np.arange(len(ids))).tolist() == ids.tolist()
    some = np.random.default_rng(1).permutation(len(ids))[:500]
    assert segment.access(some).tolist() == ids[some].tolist()
    for position in some[:20]:
        assert segment.access(np.array([position]))[0] == ids[position]


def test_words_are_cut_as_the_library_cuts_them():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.tokenizer_file())
    tool = tokens.word_encoder()
    letters = [chr(c) for c in range(0x80, 0x2C0)] + ["ǅ", "ſ", "İ", "Σ", "ς", "K", "e\u0301", "日"]
    words = [f"{a}{c}{b}" for c in letters for a, b in (
        ("", ""), ("x", "y"), ("(", "),"), ("<", "|>"), ("--A", "Z!?"), ("é", ".b"), ("_", "'s"))]
    words += ["ΑΣ.", "ΟΔΟΣ,Σ", "é<|endoftext|>", "\u0338=é", "=é\u0338", "É1É", "naïve\x00"]
    for first in range(0, len(words), 7):
        text = " ".join(words[first:first + 7]) + "\n"
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tool.encode(text), np.uint32).tolist() == want, text


def written_documents(spark, docs, **options):
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, **options)
    segments = tokens.read_segments(spark, path)
    return segments, tokens.read_documents(segments, with_ids=True).orderBy("start").collect()


def test_files_hold_the_ids_of_the_library_in_order(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.tokenizer_file())
    docs = awkward(spark)
    segments, found = written_documents(spark, docs, segment_tokens=50)
    assert segments.count() > 1
    want = sorted(
        ((r["doc_id"] is not None, r["doc_id"] or 0,
          library.encode(r["text"] or "", add_special_tokens=False).ids + [2])
         for r in docs.collect()), key=lambda r: r[:2])
    got = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert got == [w[:2] for w in want]
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in found) == sorted(
        (w[1] if w[0] else -1, w[2]) for w in want)
    start = 0
    for row in found:
        assert row["start"] == start and row["n_tokens"] == len(row["ids"])
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
        start += row["n_tokens"]


def test_wanted_tokens_are_looked_up(spark):
    segments, found = written_documents(spark, awkward(spark).filter("doc_id in (2, 8)"))
    ids = {r["doc_id"]: r["ids"] for r in found if r["doc_id"] == 2}
    wanted = spark.createDataFrame([(2, 0), (2, 3), (2, 10**6), (99, 0)], "doc_id long, pos long")
    got = sorted(tuple(r) for r in tokens.tokens_at(segments, wanted).collect())
    assert got == [(2, 0, ids[2][0]), (2, 3, ids[2][3])]


def test_no_documents_give_no_rows(spark):
    assert written_documents(spark, empty(spark))[1] == []
