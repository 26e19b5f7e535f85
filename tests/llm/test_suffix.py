"""Operator 6: repeated passages by merged Burrows-Wheeler transforms."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from common_rows import awkward, empty

from trackmart.llm import suffix
from trackmart.llm.bwt import Shard, merge


def test_merge_orders_all_suffixes_and_gives_their_common_prefixes():
    draw = random.Random(1)
    for trial in range(60):
        shards, suffixes, string = [], [], 0
        for shard in range(draw.randint(1, 4)):
            symbols, ends, at = [], [], 0
            for _ in range(draw.randint(1, 3)):
                one = [draw.randint(1, 2) for _ in range(draw.randint(0, 8))]
                for j in range(len(one) + 1):
                    suffixes.append(([(s, 0) for s in one[j:]] + [(0, string)], shard, at + j))
                symbols += [*one, 0]
                ends.append(len(symbols) - 1)
                at, string = at + len(one) + 1, string + 1
            shards.append(Shard(np.array(symbols), np.array(ends)))
        suffixes.sort(key=lambda s: [(a if a else -1, b) for a, b in s[0]])
        owner, place, common = merge(shards, 20)
        assert list(zip(owner.tolist(), place.tolist())) == [s[1:] for s in suffixes]
        for i in range(1, len(suffixes)):
            a, b = suffixes[i - 1][0], suffixes[i][0]
            shared = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y or x[0] == 0))
            assert common[i] == shared, trial


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i:i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if times[d[i:i + width]] > 1:
                covered[i:i + width] = b"\1" * width
        kept = bytes(c for c, gone in zip(d, covered) if not gone)
        spans = sum(1 for i, gone in enumerate(covered) if gone and (i == 0 or not covered[i - 1]))
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def sample_texts(seed):
    draw = random.Random(seed)
    base = "".join(draw.choice("ab cdefghé") for _ in range(500))
    texts = []
    for _ in range(50):
        a = draw.randrange(400)
        b = draw.randrange(a, 500)
        texts.append("".join(draw.choice("abc") for _ in range(draw.randrange(100)))
                     + base[a:b] + "".join(draw.choice("xyz ") for _ in range(draw.randrange(60))))
    return [*texts, texts[3], texts[3], "a" * 150, "ab" * 60, base, base + base, "", None]


@pytest.mark.parametrize("width, gram, crowd", [(40, 8, 4096), (33, 16, 4096), (48, 32, 4096),
                                                (40, 8, 1)])
def test_documents_equal_the_plain_form(spark, width, gram, crowd):
    texts = sample_texts(width)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffix.remove_repeats(docs, width, gram, crowd).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == brute(texts, width)


def test_blocks_and_shards_do_not_change_the_result():
    draw = random.Random(5)
    base = bytes(draw.randrange(4) for _ in range(300))
    segments = [(50, 40, base[:100] + bytes([i % 7]) + base[101:200]) for i in range(40)]
    one = suffix.repeated_starts(segments, 40, 1)
    for shards in (2, 3, 8):
        assert [s.tolist() for s in suffix.repeated_starts(segments, 40, shards)] == [
            s.tolist() for s in one]


def test_awkward_rows_and_none(spark):
    docs = awkward(spark)
    rows = docs.collect()
    found = suffix.remove_repeats(docs, with_rest=True).collect()
    want = Counter(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], 400)))
    assert Counter((r["doc_id"], tuple(r)[1:5]) for r in found) == want
    for row in found:
        gone = sum(s["b"] - s["a"] for s in row["removed"])
        assert gone == row["n_removed"] and len(row["rest"]) == row["n_bytes"] - gone
    assert suffix.remove_repeats(empty(spark)).count() == 0
