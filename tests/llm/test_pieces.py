"""Operator 10: SentencePiece encoding and decoding."""

import itertools

import numpy as np
import pytest
from common_rows import awkward, empty

from trackmart.llm import pieces

TEXTS = ["", " ", "  two  spaces ", "The cat's hat & more %%%%", "日本語テスト🙂 x\ty\n\nz", "a" * 500,
         "\x00\x01", "🙂" * 40 + " ok", "ÀÉÎÕÜ ßøł", "word " * 50, "x" * 97 + " " + "é" * 60]


@pytest.fixture(scope="module")
def model():
    return pieces.piece_model(pieces.model_file())


def ids_of(model, text):
    return np.frombuffer(model.encode_batch([text])[0], "<u4").tolist()


def test_trie_holds_its_pieces_only(model):
    base, check, value = model.trie.lists

    def find(data):
        state = 0
        for byte in data:
            child = base[state] + byte + 1
            if check[child] != state:
                return -1
            state = child
        return value[state]

    known = {model.piece_bytes[i]: i for i in range(len(model.texts))
             if model.scores[i] > -1e8 and model.texts[i]}
    for piece, number in itertools.islice(known.items(), 0, None, 37):
        assert find(piece) == number
        longer = piece + b"\xff"
        assert find(longer) == -1


def test_scores_equal_those_of_the_library(model):
    """The library's unigram search over the same pieces and log scores finds no better cut."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(pieces.model_file(), "rb") as file:
        proto.ParseFromString(file.read())
    for i, piece in enumerate(proto.pieces):
        piece.score = float(model.scores[i]) if piece.type in (1, 4) else 0.0
    proto.trainer_spec.model_type = 1
    proto.normalizer_spec.remove_extra_whitespaces = False
    library = SentencePieceProcessor(model_proto=proto.SerializeToString())

    def total(ids):
        return sum(model.scores[i] if model.scores[i] > -1e8 else model.unknown for i in ids)

    for text in TEXTS:
        mine, theirs = ids_of(model, text), library.encode(text) if text else []
        assert len(mine) == pytest.approx(len(theirs), abs=3)
        assert total(mine) == pytest.approx(total(theirs), rel=1e-4)


def test_cuts_equal_the_best_of_all_cuts():
    texts = ["<unk>", *[f"<0x{b:02X}>" for b in range(256)], "▁", "a", "b", "ab", "▁a", "aba", "bab",
             "▁ab", "é"]
    scores = [0.0] * 257 + [-2.0, -1.5, -1.7, -2.5, -2.2, -3.9, -4.4, -3.0, -5.0]
    kinds = [2, *[6] * 256, *[1] * 9]
    model = pieces.Pieces(texts, scores, kinds, ranks=False)
    known = {t: s for t, s, k in zip(texts, scores, kinds) if k == 1}

    def best(word):
        if not word:
            return 0.0
        options = [known[word[:n]] + best(word[n:]) for n in range(1, 5) if word[:n] in known]
        if word[0] not in known:
            options.append(model.unknown + best(word[1:]))
        return max(options)

    words = ["▁" + "".join(w) for n in range(6) for w in itertools.product("abé🙂", repeat=n)][::3]
    data = [w.encode() for w in words]
    many = model.cut_many(data)
    for word, raw, ids in zip(words, data, many):
        assert model.cut_one(raw) == ids
        spelled = b"".join(model.piece_bytes[i] for i in ids)
        assert spelled == raw
        lone = sum(1 for i in ids if 1 <= i <= 256) / 4
        total = sum(scores[i] for i in ids if i > 256) + lone * model.unknown
        assert total == pytest.approx(best(word)), word


def test_decoding_gives_every_text_back(model):
    for text in TEXTS:
        assert model.decode(ids_of(model, text)) == text
    assert model.decode(ids_of(model, "naïve▁x")) == "naïve x"
    assert model.encode_batch([None]) == [b""]


def test_documents(spark):
    docs = awkward(spark)
    found = pieces.encode_documents(docs).collect()
    assert len(found) == 11
    assert all(r["text_back"] and r["n_tokens"] == len(r["ids"]) for r in found)
    assert all(r["ids"] == [] for r in found if r["doc_id"] in (3, 4))
    assert pieces.encode_documents(empty(spark)).count() == 0


def test_words_of_like_length_are_cut_together(model, monkeypatch):
    """A few long words among many short ones do not widen the table of all."""
    cells, cut = [], model.cut_packed

    def watched(words):
        cells.append((len(words) * max(map(len, words)), sum(map(len, words))))
        return cut(words)

    monkeypatch.setattr(model, "cut_packed", watched)
    words = [f"w{i:05d}" for i in range(20_000)] + ["é" * 40 + str(i) for i in range(20)]
    data = model.encode_batch([" ".join(words)])[0]
    assert model.decode(np.frombuffer(data, "<u4").tolist()) == " ".join(words)
    assert sum(c for c, _ in cells) < 3 * sum(b for _, b in cells)


def test_packed_cuts_equal_single_ones(model):
    words = [w.encode() for text in TEXTS for w in ["▁" + text, text, text[::-1]] if w]
    words += ["é\x00🙂"[i % 3:].encode() * (i % 31) + b"the" * (i % 5) + b"\xe6\x97\xa5" for i in range(99)]
    assert model.cut_many(words) == [model.cut_one(w) for w in words]
    assert model.cut_packed([]) == []
