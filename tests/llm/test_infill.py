"""Operator 12: fill-in-middle examples from compressed frames."""

import hashlib
import re

import pytest
from common_rows import awkward, empty
from pyspark.sql import functions as F

from trackmart.llm import infill
from trackmart.session import scratch_path

UNIT = re.compile(r"[^\n]*\n|[^\n]+")
TEXTS = ["", "\n", "a", "a\n", "\n\na\n\n", "naïve\n日本語\n🙂", "x" * 100, "l1\nl2\nl3\nl4",
         "a<\nP>b\n>c<S\n<", "line\n" * 300, "has <M> marker\nb", "\r\n \x0b\n\x85 q\n"]


def brute(doc_id, text, share=100, suffix_first=50):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:one], units[one:two], units[two:]))
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h3 % 100 >= share:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < suffix_first:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("frame_chars", [1, 3, 7, 64, 100_000])
def test_frames_give_units_and_characters(frame_chars):
    for text in TEXTS:
        units = UNIT.findall(text)
        assert infill.unit_count(text) == len(units)
        frames = infill.Frames(len(units), len(text), frame_chars, *infill.pack(text, frame_chars))
        for k in range(len(units) + 1):
            frames.held.clear()
            assert frames.end_of(k) == sum(map(len, units[:k]))
            assert len(frames.held) <= 1
        for start in range(0, len(text) + 1, 1 + len(text) // 9):
            for end in range(start, len(text) + 1, 1 + len(text) // 7):
                assert "".join(frames.stream(start, end)) == text[start:end]


def examples(spark, docs, frame_chars=infill.FRAME_CHARS, **options):
    path = scratch_path(spark, "frames")
    infill.write_frames(docs, path, frame_chars)
    stored = infill.read_frames(spark, path)
    return stored, infill.fill_in_middle(stored, **options)


@pytest.mark.parametrize("options", [{}, {"share": 60, "suffix_first": 20}, {"frame_chars": 16}])
def test_examples_and_the_way_back(spark, options):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(120)]
    docs = awkward(spark).select("doc_id", "text").union(
        spark.createDataFrame(rows, "doc_id long, text string"))
    stored, found = examples(spark, docs, **options)
    back = found.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    drawn = {k: v for k, v in options.items() if k != "frame_chars"}
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = [brute(*row, **drawn) for row in texts]
    got = [(r["doc_id"], r["units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
           for r in back]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len({r["form"] for r in back}) == 3
    for r in back:
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
    came = sorted(((r["doc_id"], r["back"]) for r in back), key=repr)
    assert came == sorted(((i, t or "") for i, t in texts), key=repr)
    again = sorted((tuple(r) for r in infill.texts_of(stored).collect()), key=repr)
    assert again == came


def test_no_documents_give_no_examples(spark):
    assert examples(spark, empty(spark))[1].collect() == []
