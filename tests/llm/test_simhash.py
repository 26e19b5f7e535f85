"""Operator 2: SimHash near-duplicates."""

import random

import numpy as np
import pytest
import xxhash
from common_rows import awkward, empty

from trackmart.llm import simhash
from trackmart.llm.components import components


def plain_fingerprint(text, size=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=3):
    """(doc_id, fingerprint) rows with the smallest id reached, by comparing all pairs."""
    values = np.array([f for _, f in rows], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance):
            root[find(i)] = find(int(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [least.get(find(i)) for i in range(len(rows))]


def test_documents_equal_the_plain_form(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    want = sorted((str(d), f"{f:016x}", c) for (d, f), c in zip(rows, plain_components(rows)))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == want


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_every_close_pair_is_found(spark, distance):
    draw = random.Random(distance)
    centres = [draw.getrandbits(64) for _ in range(25)]
    values = set()
    for centre in centres:
        for _ in range(12):
            value = centre
            for bit in draw.sample(range(64), draw.randint(0, 7)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    table = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    got = simhash.close_pairs(table, distance).collect()
    found = {(r["a"], r["b"]) for r in got}
    want = set()
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                want.add(tuple(sorted((simhash.signed(a), simhash.signed(b)))))
    assert found == want and len(got) == len(want)


def test_a_value_that_many_share_is_searched_elsewhere():
    blocks = [list(range(i, i + 16)) for i in range(0, 64, 16)]
    counts = np.ones((4, 1 << 16), np.int64)
    counts[0, 7] = 1_000_000
    plan = simhash.Plan(blocks, counts, 3, 4)
    thresholds, _ = plan.allocate(np.array([7], dtype=np.uint64))
    assert thresholds[0, 0] == -1 and (thresholds + 1).sum() == 4


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(1000, i) for i in range(1001, 1100)]
    links = spark.createDataFrame(chain + hub + [(5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 1000 for i in range(1000, 1100)}}


def edited(draw, base, vocabulary):
    """Near copies of every kind: words changed, appended, cut, inserted, and longer rewrites."""
    n = len(base)
    for share in (0.005, 0.02, 0.1, 0.4):
        some = max(1, int(n * share))
        changed = list(base)
        for at in draw.sample(range(n), some):
            changed[at] = draw.choice(vocabulary)
        more = [draw.choice(vocabulary) for _ in range(some)]
        yield from (changed, base + more, more + base, base[:-some], base[some:],
                    base[:n // 2] + more + base[n // 2:])


def test_one_document_of_each_group_stays(spark):
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(900)]
    texts = [[], [], ["one"]]
    for n in [2, 3, 5, 8, 20, 60, 150, 400, 900] * 2:
        base = [draw.choice(vocabulary) for _ in range(n)]
        texts += [base, *edited(draw, base, vocabulary)]
    draw.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    least = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = sorted(r["doc_id"] for r in simhash.drop_near_copies(docs).collect())
    assert kept == sorted(set(least)) and len(kept) < len(rows) - 40


def test_one_row_of_rows_without_an_id_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text, "b"), (None, text, "a"), (7, "something else, said in a few words", "c"),
            (None, "something else, said in a few words", "d"), (7, text + " x", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    near = plain_components([(r[0], plain_fingerprint(r[1])) for r in rows])
    kept = sorted(tuple(map(str, r)) for r in simhash.drop_near_copies(docs).collect())
    linked = near[0] == 7
    assert kept == sorted(tuple(map(str, r)) for r in ([rows[2], rows[4]] if linked
                                                       else [rows[1], rows[2], rows[4]]))


def test_awkward_rows_and_none(spark):
    docs = awkward(spark)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    rows = docs.collect()
    least = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
    groups = {(c, plain_fingerprint(r["text"]) if c is None else 0) for r, c in zip(rows, least)}
    assert kept.count() == 7 and len(groups) <= 7
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_copies(empty(spark)).count() == 0
