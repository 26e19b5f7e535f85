"""Queries 11 to 13 against plain Python over whole tables."""

import functools
import hashlib
import zlib

import numpy as np
import pytest
from test_infill import brute as example

from trackmart.llm import bytebpe, queries

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    found = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"] or "") for r in found]


def brute_runs(words):
    """Every maximal stretch by its smallest period: words q apart compared for every q."""
    table: dict = {}
    ids = np.array([table.setdefault(w, len(table)) for w in words], np.int64)
    n, best = len(ids), {}
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(np.int8)
        turns = np.flatnonzero(np.diff(same))
        for i, j in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q - i), q)
    return sorted(((s, length, q) for (s, length), q in best.items()), key=lambda r: (r[0], r[2]))


def test_periodic_runs(spark, texts):
    want = {}
    for doc_id, text in texts:
        words = text.encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want[doc_id] = (doc_id, len(runs), *best, milli, sha(lines), sha(kept))
    found = queries.op11(spark, SF).collect()
    assert len(found) == len(texts) and {tuple(r) for r in found} == set(want.values())
    assert sum(r["n_runs"] > 0 for r in found) > 10


def test_fill_in_middle(spark, texts):
    want = set()
    for doc_id, text in texts:
        *row, output = example(doc_id, text)
        want.add((*row, sha(output), sha(text)))
    found = queries.op12(spark, SF).collect()
    assert len(found) == len(texts) and {tuple(r) for r in found} == want


def test_byte_bpe(spark, texts):
    import tiktoken

    tool = bytebpe.byte_bpe(bytebpe.rank_file(), bytebpe.public_pattern())
    encode = functools.partial(tiktoken.Encoding(
        "own", pat_str=bytebpe.public_pattern(), mergeable_ranks=tool.ranks,
        special_tokens={}).encode_ordinary)
    want = set()
    for doc_id, text in texts:
        ids = encode(text)
        want.add((doc_id, len(ids), sha(",".join(map(str, ids))), sha(text)))
    found = queries.op13(spark, SF).collect()
    assert len(found) == len(texts) and {tuple(r) for r in found} == want
