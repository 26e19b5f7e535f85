"""Removal of repeated passages by merged Burrows-Wheeler transforms (operator 6).

A string of ``width`` bytes is removed where it starts at two places or more.

1. Every such string has an anchor: the leftmost of its smallest ``GRAM``-byte
   grams by hash. Equal strings have equal anchors at equal places. A document
   is cut into stretches of starts with one anchor; a stretch and the
   ``width - 1`` bytes after it are a segment. Only anchors and digests of
   segments move: a segment that occurs twice is repeated as a whole, and an
   anchor that occurs once holds no repeat. Both are decided for good.
2. What is left are different segments with a common anchor. They are strings
   of 16-byte symbols, counted from the anchor. Shards of them are transformed,
   and the transforms merged by interleave refinement, which gives the common
   prefixes of neighbours; rows with as many symbols in common as any repeat
   has are repeated intervals.
3. The bytes before and after the symbols decide, for each of the 16 starts
   of a row, whether the whole string is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.bwt import Shard, merge
from trackmart.llm.common import arrow_map, rows_of, small_batches, written

WIDTH, GRAM, SYMBOL = 400, 32, 16
#: Bytes of segments that are transformed together, and the shards they are split into.
BLOCK_BYTES, SHARDS = 1 << 20, 4
#: An anchor with more different segments is compared by hashes of whole strings, see ``_crowded``.
CROWD = 4096

_BYTES = np.random.default_rng(6).integers(0, 1 << 32, 256, dtype=np.uint32)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of every ``gram`` bytes (a power of two), by doubling."""
    h, factor, step = _BYTES[data], 0x9E3779B1, 1
    while step < gram:
        h = h[:-step] * np.uint32(factor) + h[step:]
        factor = factor * factor & 0xFFFFFFFF
        step *= 2
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return h


def _sliding(values: np.ndarray, size: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` over every ``size`` values in a row."""
    n = len(values)
    padded = np.full(-(-n // size) * size, fill, values.dtype)
    padded[:n] = values
    table = padded.reshape(-1, size)
    before = best.accumulate(table, axis=1).ravel()
    after = best.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(after[:n - size + 1], before[size - 1:n])


def stretches(data: bytes, width: int, gram: int) -> list[tuple[int, int, int]]:
    """(lo, anchor, hi): the strings that start in lo..hi have their anchor at that place."""
    if len(data) < width:
        return []
    size = width - gram + 1
    h = gram_hashes(np.frombuffer(data, np.uint8), gram)
    least = _sliding(h, size, np.minimum, 0xFFFFFFFF)
    edge = np.zeros(size - 1, h.dtype)
    greatest = _sliding(np.concatenate([edge, least, edge]), size, np.maximum, 0)
    at = np.flatnonzero(h == greatest)
    values, places, last = h[at].tolist(), at.tolist(), len(data) - width
    before, after, stack = [-1] * len(places), [1 << 62] * len(places), []
    for i, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            after[stack.pop()] = places[i]
        if stack:
            before[i] = places[stack[-1]]
        stack.append(i)
    out = []
    for place, left, right in zip(places, before, after):
        lo, hi = max(place - size + 1, left + 1, 0), min(place, right - size, last)
        if lo <= hi:
            out.append((lo, place, hi))
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of doc_id and text; rows with the same key are alike."""
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-1 << 63)).alias("d"),
                       F.xxhash64("text").alias("h"))


def _segments(keyed: DataFrame, width: int, gram: int) -> DataFrame:
    """(d, h, anchor, digest, lo, place, hi) of every document."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for d, h, text in rows_of(batches, "d", "h", "text"):
            data = (text or "").encode()
            for lo, place, hi in stretches(data, width, gram):
                anchor = xxhash.xxh64_intdigest(data[place:place + gram]) - (1 << 63)
                digest = xxhash.xxh3_128_digest(data[lo:hi + width], place - lo)
                yield d, h, anchor, digest, lo, place, hi

    return arrow_map(keyed.select("d", "h", "text"), rows,
                     "d long, h long, anchor long, digest binary, lo int, place int, hi int",
                     batch_rows=20_000)


def _contents(keyed: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(anchor, digest, crowd, off, starts, content) of the ``wanted`` segments.

    The places of a document are gathered first, so that its text moves once.
    """
    places = wanted.groupBy("d", "h").agg(F.collect_list(
        F.struct("anchor", "digest", "crowd", "lo", "place", "hi")).alias("places"))
    # Rows of one key are alike: their segments are given once.
    joined = keyed.select("d", "h", "text").join(places, ["d", "h"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for text, found in rows_of(batches, "text", "places"):
            data = text.encode()
            for p in found:
                lo, hi = p["lo"], p["hi"]
                yield (p["anchor"], p["digest"], p["crowd"], p["place"] - lo, hi - lo + 1,
                       data[lo:hi + width])

    return arrow_map(joined, rows, "anchor long, digest binary, crowd boolean, off int, "
                                   "starts int, content binary")


# -- repeats within a block -----------------------------------------------------

def repeated_starts(segments: list[tuple[int, int, bytes]], width: int = WIDTH,
                    shards: int = SHARDS) -> list[np.ndarray]:
    """For each segment (off, starts, content), the starts below ``starts`` whose ``width`` bytes
    occur again among the segments. ``off`` is the place of the anchor."""
    depth = (width - SYMBOL + 1) // SYMBOL
    rest = width - depth * SYMBOL
    buffer = np.frombuffer(b"".join(c for _, _, c in segments) + bytes(width), np.uint8)
    lengths = np.array([len(c) for _, _, c in segments])
    base = np.cumsum(lengths) - lengths
    grid = np.array([off % SYMBOL for off, _, _ in segments])
    counts = (lengths - grid) // SYMBOL
    limit = np.array([starts for _, starts, _ in segments])

    # Symbols are ranks of 16 bytes; a 0 after each string stands for its sentinel.
    string = np.repeat(np.arange(len(segments)), counts + 1)
    first = np.cumsum(counts + 1) - counts - 1
    nth = np.arange(len(string)) - first[string]
    where = base[string] + grid[string] + nth * SYMBOL
    real = nth < counts[string]
    raw = buffer[where[real][:, None] + np.arange(SYMBOL)].view(">u8")
    symbols = np.zeros(len(string), np.int64)
    symbols[real] = _ranks([raw[:, 0], raw[:, 1]]) + 1

    parts, cut = [], np.linspace(0, len(segments), min(shards, len(segments)) + 1).astype(int)
    offsets = []
    for a, b in zip(cut[:-1], cut[1:]):
        lo, hi = first[a], first[b - 1] + counts[b - 1] + 1
        parts.append(Shard(symbols[lo:hi], first[a:b] + counts[a:b] - lo))
        offsets.append(lo)
    owner, place, common = merge(parts, depth)
    place = place + np.array(offsets)[owner]

    # Repeated intervals: runs of rows with the full depth in common.
    group = np.cumsum(common < depth)
    members = np.bincount(group)[group] > 1
    group, place = group[members], place[members]
    of, at = string[place], grid[string[place]] + nth[place] * SYMBOL
    found: list[list[np.ndarray]] = [[] for _ in segments]
    for head in range(SYMBOL):
        start = at - head
        on = (start >= 0) & (start < limit[of])
        if np.count_nonzero(on) < 2:
            continue
        # The bytes of the string outside its whole symbols.
        steps = np.concatenate([np.arange(-head, 0),
                                depth * SYMBOL + np.arange(rest - head)])
        edge = np.zeros((np.count_nonzero(on), -(-rest // 8) * 8), np.uint8)
        edge[:, :rest] = buffer[(base[of[on]] + at[on])[:, None] + steps]
        words = edge.view(np.uint64)
        key = _ranks([group[on].astype(np.uint64), *(words[:, i] for i in range(words.shape[1]))])
        again = np.bincount(key)[key] > 1
        for segment, s in zip(of[on][again].tolist(), start[on][again].tolist()):
            found[segment].append(s)
    return [np.unique(np.array(s, dtype=np.int64)) for s in found]


def _ranks(columns: list[np.ndarray]) -> np.ndarray:
    """Ranks of rows by their columns; equal rows have one rank."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for column in columns:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The bytes that strings at the sorted ``starts`` cover, as (begin, end)."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > width) + 1
    firsts = starts[np.concatenate([[0], breaks])]
    lasts = starts[np.concatenate([breaks - 1, [len(starts) - 1]])]
    return list(zip(firsts.tolist(), (lasts + width).tolist()))


def _merged_blocks(contents: DataFrame, width: int) -> DataFrame:
    """(digest, runs): what is repeated in segments that share an anchor, by merged transforms.

    The segments of an anchor come to one task, where as many anchors as fit a
    block are taken together.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[tuple] = []
        size, last = 0, None

        def compared() -> Iterator[tuple]:
            starts = repeated_starts([row[1:] for row in held], width)
            for row, found in zip(held, starts):
                if len(found):
                    yield row[0], [{"a": a, "b": b} for a, b in runs(found, width)]

        for anchor, digest, off, n, content in rows_of(
                batches, "anchor", "digest", "off", "starts", "content"):
            if anchor != last and size >= BLOCK_BYTES:
                yield from compared()
                held, size = [], 0
            held.append((digest, off, n, content))
            size += len(content)
            last = anchor
        if held:
            yield from compared()

    dealt = contents.repartition("anchor").sortWithinPartitions("anchor")
    return arrow_map(dealt, rows, "digest binary, runs array<struct<a: int, b: int>>")


def _crowded(contents: DataFrame, width: int) -> DataFrame:
    """(digest, runs) for anchors with very many segments: hashes of all their strings are counted,
    which no task has to do for a whole anchor."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for digest, n, content in rows_of(batches, "digest", "starts", "content"):
            for start in range(n):
                yield digest, start, xxhash.xxh3_128_digest(content[start:start + width])

    strings = arrow_map(contents, rows, "digest binary, start int, string binary",
                        batch_rows=20_000)
    again = strings.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1")
    found = strings.join(again, "string").groupBy("digest").agg(
        F.collect_list("start").alias("starts"))

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for digest, starts in rows_of(batches, "digest", "starts"):
            yield digest, [{"a": a, "b": b} for a, b in runs(np.unique(np.array(starts)), width)]

    return arrow_map(found, covered, "digest binary, runs array<struct<a: int, b: int>>")


# -- documents -------------------------------------------------------------------

def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM,
                   crowd: int = CROWD) -> DataFrame:
    """(d, h, spans): per key of a document, the covered byte runs, which can overlap."""
    keyed = _keyed(docs)
    segments = written(_segments(keyed, width, gram), "segments")
    kinds = segments.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.min(F.struct("d", "h", "lo", "place", "hi")).alias("one"))
    kinds = written(kinds, "kinds")
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("different")).filter("different > 1")
    wanted = kinds.join(anchors, "anchor").select(
        "anchor", "digest", (F.col("different") > crowd).alias("crowd"), "one.*")
    contents = written(_contents(keyed, wanted, width), "contents")
    compared = _merged_blocks(contents.filter("not crowd"), width)
    if not contents.filter("crowd").isEmpty():
        compared = compared.unionByName(_crowded(contents.filter("crowd"), width))
    whole = F.array(F.struct(F.lit(0).alias("a"), F.lit(-1).alias("b")))
    found = kinds.filter("n > 1").select("digest", whole.alias("runs")).unionByName(
        compared.join(kinds.filter("n > 1").select("digest"), "digest", "left_anti"))
    placed = segments.join(found, "digest").select(
        "d", "h", F.transform("runs", lambda r: F.struct(
            (F.col("lo") + r["a"]).alias("a"),
            F.when(r["b"] < 0, F.col("hi") + width).otherwise(F.col("lo") + r["b"]).alias("b"),
        )).alias("runs"))
    return placed.groupBy("d", "h").agg(F.flatten(F.collect_list("runs")).alias("spans"))


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that some spans cover; touching ones are one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, crowd: int = CROWD,
                   with_rest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256 [, removed, rest]) of every document.

    Texts are UTF-8 bytes; null is empty. Every byte goes that a string of
    ``width`` bytes covers which also starts elsewhere, in the same document
    or another. ``rest`` are the bytes that stay, ``removed`` the runs that
    went. Rows that repeat a document whole lose it whole. Other columns of
    ``docs`` are ignored. Empty in, empty out.
    """
    small_batches(docs.sparkSession)
    spans = written(repeated_spans(docs, width, gram, crowd), "spans")
    joined = _keyed(docs).join(spans, ["d", "h"], "left")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text, found in rows_of(batches, "doc_id", "text", "spans"):
            data = (text or "").encode()
            gone = union([(s["a"], s["b"]) for s in found or ()])
            rest, at = [], 0
            for a, b in gone:
                rest.append(data[at:a])
                at = b
            rest.append(data[at:])
            kept = b"".join(rest)
            row = (doc_id, len(data), len(data) - len(kept), len(gone),
                   hashlib.sha256(kept).hexdigest())
            yield (*row, [{"a": a, "b": b} for a, b in gone], kept) if with_rest else row

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return arrow_map(joined.select("doc_id", "text", "spans"), rows, schema + (
        ", removed array<struct<a: int, b: int>>, rest binary" if with_rest else ""))
