"""Operator 13: byte-level BPE."""

import itertools
import random

import pytest
import tiktoken
from common_rows import awkward, empty
from pyspark.sql import functions as F

from trackmart.llm import bytebpe

TEXTS = ["", " ", "  two  spaces \n\n\t", "The cat's hat & more %%%% it'S we'll", "日本語テスト🙂 x\ty",
         "\x00\x01\x1c\x85\xa0", "🙂" * 40, "ÀÉÎÕÜ ßøł ﬁ ǆ", "मानक हिन्दी ข้อความ 한국어 1٢३",
         "<|endoftext|> a", "x" * 97 + " " + "é" * 260, "\u2028\u3000a\U00010ee7a \U00016ea7 \u0378",
         "a\r\n b", "'s's", "1234567890" * 30]


@pytest.fixture(scope="module")
def tool():
    return bytebpe.byte_bpe(bytebpe.rank_file(), bytebpe.public_pattern())


@pytest.fixture(scope="module")
def library(tool):
    return tiktoken.Encoding("own", pat_str=bytebpe.public_pattern(), mergeable_ranks=tool.ranks,
                             special_tokens={})


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_library(tool, library, text):
    ids = tool.encode(text)
    assert ids == library.encode_ordinary(text)
    assert tool.decode(ids) == text.encode()


def test_every_character_is_cut_as_the_library_cuts_it(tool, library):
    codes = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(codes), 4096):
        text = "".join(f"a{c}a1{c}1! {c}{c}  {c}?" for c in codes[first:first + 4096:3])
        assert tool.encode(text) == library.encode_ordinary(text)


def test_spaces_beside_other_white_space(tool, library):
    assert tool.spaced and not bytebpe.cuts_at_spaces(r"\S+ ?|\s+(?!\S)|\s+")
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choice([" ", " ", "\n", "\t", "\x85", "\x1c", "a", "b'", "9", "é.", "'s"])
                       for _ in range(draw.randrange(0, 12)))
        assert tool.encode(text) == library.encode_ordinary(text), repr(text)


def test_random_texts(tool, library):
    draw = random.Random(5)
    alphabets = ["ab", "the aeinos", "0123 ,.", "éèêaàçœ ", "日本語の文字 ", "\n\t  a", "абвгде "]
    for _ in range(1500):
        letters = draw.choice(alphabets)
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(0, 400)))
        assert tool.encode(text) == library.encode_ordinary(text), text


def test_backtracking_equals_merging_for_any_ranks():
    """Small vocabularies whose longest tokens are often wrong, unreachable ones included."""
    draw = random.Random(3)
    for _ in range(40):
        tokens = {bytes(draw.choices(b"abc", k=draw.randrange(2, 6))) for _ in range(25)}
        ranks = {bytes([b]): b for b in range(256)}
        order = sorted(tokens)
        draw.shuffle(order)
        ranks |= {token: 256 + i for i, token in enumerate(order)}
        tool = bytebpe.ByteBPE(ranks, r"\S+")
        for n in range(1, 7):
            for word in itertools.islice(itertools.product(b"abc", repeat=n), 0, None, 3):
                data = bytes(word)
                want = [ranks[data]] if data in ranks else tool.merged(data)
                assert tool.encode_cut(data) == want


def test_long_cuts_take_linear_time(tool, library):
    import time

    start = time.perf_counter()
    for text in ("a" * 300_000, "ab" * 150_000, " " * 300_000, "日本" * 60_000):
        ids = tool.encode(text)
        assert tool.decode(ids) == text.encode()
    assert time.perf_counter() - start < 30
    for text in ("a" * 5_000, "ab" * 2_500, "日本" * 1000):
        assert tool.encode(text) == library.encode_ordinary(text)


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        bytebpe.ByteBPE({b"a": 0}, r"\S+")


def test_documents(spark, library):
    docs = awkward(spark)
    encoded = bytebpe.encode_documents(docs)
    found = bytebpe.decode_documents(encoded.withColumn("data", F.lit("x"))).collect()
    want = [(r["doc_id"], library.encode_ordinary(r["text"] or ""), (r["text"] or "").encode())
            for r in docs.collect()]
    got = [(r["doc_id"], r["ids"], bytes(r["data"])) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bytebpe.decode_documents(bytebpe.encode_documents(empty(spark))).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [bytes(r["data"]) for r in bytebpe.decode_documents(none).collect()] == [b""]
