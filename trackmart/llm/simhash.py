"""SimHash near-duplicates by generalised pigeonhole (operator 2).

Fingerprints of 64 bits are cut into parts; bits that agree more often than
chance go to one part, so that the parts depend little on each other. Two
fingerprints within ``distance`` bits of each other agree, in at least one part,
within that part's threshold, whatever thresholds are chosen that satisfy
sum(threshold + 1) = distance + 1; a threshold of -1 leaves a part out. Every
fingerprint gets the thresholds with the least work by dynamic programming on the
number of candidates that a histogram of part values leads to expect: a part
value that many share is left out and paid for with a wider search elsewhere.
It then probes the values within each threshold, and candidates are verified by
counting differing bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart.llm.common import FOLD, arrow_map, map_batches, rows_of, small_batches, written
from trackmart.llm.components import components

BITS = 64
BLOCK = 16
#: What a probe costs, in candidates to verify: its row is shuffled, a candidate is a few instructions.
PROBE_COST = 30.0


# -- fingerprints --------------------------------------------------------------

def shingle_spans(words: list[bytes], size: int) -> tuple[bytes, list[int], list[int]]:
    """The words joined by spaces, and where its shingles begin and end.

    Fewer words than ``size`` are one shingle; none are none.
    """
    joined = b" ".join(words)
    if not words:
        return joined, [], []
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - size + 1)
    return joined, starts[:count].tolist(), ends[len(words) - count:].tolist()


def shingle_hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    joined, starts, ends = shingle_spans(words, size)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], dtype=np.uint64)


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 where over half of the hashes have it; zero without hashes."""
    if not len(hashes):
        return 0
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, size: int = 3, seeds: tuple[int, ...] = (42,),
                 *keys: str) -> DataFrame:
    """(doc_id, f0, f1, ...): a fingerprint of each document and seed, as a signed long.

    Texts are folded A-Z only and taken whole. A null, empty or blank text has
    zero. Rows come out one for one, with the long columns ``keys`` after
    doc_id; other columns of ``docs`` are ignored.
    """
    small_batches(docs.sparkSession)
    names = ("doc_id", *keys)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for *own, text in rows_of(batches, *names, "text"):
            words = (text or "").encode().translate(FOLD).split()
            yield (*own, *(signed(fingerprint_of(shingle_hashes(words, size, s)))
                           for s in seeds))

    columns = [*names, *(f"f{i}" for i in range(len(seeds)))]
    return arrow_map(docs.select(*names, "text"), rows, ", ".join(f"{c} long" for c in columns),
                     batch_rows=5000)


# -- parts and thresholds ------------------------------------------------------

def _unsigned(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)


def _bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")


def agreement(fps: DataFrame) -> np.ndarray:
    """Correlation of every two bits over all fingerprints: 64 x 64, whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bit_matrix(_unsigned(batch)).astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        for i, row in enumerate(total.astype(np.int64).tolist()):
            yield i, n, row

    counted = arrow_map(fps, count, "i int, n long, ones array<long>")
    sums = [F.sum(F.col("ones")[j]).alias(f"c{j}") for j in range(BITS)]
    rows = counted.groupBy("i").agg(F.sum("n").alias("n"), *sums).collect()
    if not rows:
        return np.eye(BITS)
    n = max(rows[0]["n"], 1)
    both = np.zeros((BITS, BITS))
    for row in rows:
        both[row["i"]] = [row[f"c{j}"] for j in range(BITS)]
    both /= n
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    return (both - np.outer(mean, mean)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray) -> list[list[int]]:
    """Blocks of 16 bits: each starts from a bit left over and adds the bits that go with it most."""
    strength = np.abs(correlation)
    left, blocks = set(range(BITS)), []
    while left:
        rest = sorted(left)
        first = max(rest, key=lambda b: (strength[b, rest].sum(), -b))
        block = [first]
        left.discard(first)
        while len(block) < BLOCK:
            best = max(sorted(left), key=lambda b: (strength[b, block].sum(), -b))
            block.append(best)
            left.discard(best)
        blocks.append(block)
    return blocks


def block_values(values: np.ndarray, block: list[int]) -> np.ndarray:
    """The bits of a block, moved together."""
    out = np.zeros(len(values), dtype=np.uint64)
    for place, bit in enumerate(block):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out.astype(np.int64)


def histograms(fps: DataFrame, blocks: list[list[int]]) -> np.ndarray:
    """How many fingerprints have each value of a block: 4 x 65,536 numbers, whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total = np.zeros((len(blocks), 1 << BLOCK), np.int64)
        for batch in batches:
            values = _unsigned(batch)
            for i, block in enumerate(blocks):
                total[i] += np.bincount(block_values(values, block), minlength=1 << BLOCK)
        for i, row in enumerate(total):
            at = np.flatnonzero(row)
            yield from zip([i] * len(at), at.tolist(), row[at].tolist())

    counted = arrow_map(fps, count, "part int, value int, n long", batch_rows=20_000)
    table = np.zeros((len(blocks), 1 << BLOCK), np.int64)
    found = counted.groupBy("part", "value").agg(F.sum("n").alias("n")).toArrow()
    part, value, n = (found.column(c).to_numpy() for c in ("part", "value", "n"))
    table[part, value] = n
    return table


def within(counts: np.ndarray, most: int) -> np.ndarray:
    """[t, v]: members whose value differs from ``v`` in exactly ``t`` bits, t = 0..most."""
    out = np.zeros((most + 1, len(counts)), np.float32)
    out[0] = counts
    index = np.arange(len(counts))
    for bit in range(BLOCK):
        flipped = out[:, index ^ (1 << bit)]
        out[1:] += flipped[:-1]
    return out


class Plan:
    """Parts, and the thresholds of each fingerprint.

    With four parts of 16 bits a part's histogram gives the candidates; with
    two of 32 bits they are estimated from two histograms as if independent.
    """

    def __init__(self, blocks: list[list[int]], counts: np.ndarray, distance: int, parts: int,
                 probe_cost: float = PROBE_COST):
        self.probe_cost = probe_cost
        per = len(blocks) // parts
        self.distance = distance
        self.blocks = [blocks[i * per:(i + 1) * per] for i in range(parts)]
        near = [within(c, distance) for c in counts]
        self.near = [near[i * per:(i + 1) * per] for i in range(parts)]
        self.total = max(float(counts[0].sum()), 1.0)
        self.widths = [sum(map(len, b)) for b in self.blocks]
        self.masks = [flips(width, distance) for width in self.widths]

    def values(self, fps: np.ndarray, part: int) -> np.ndarray:
        out = np.zeros(len(fps), np.int64)
        for i, block in enumerate(self.blocks[part]):
            out |= block_values(fps, block) << (BLOCK * i)
        return out

    def costs(self, fps: np.ndarray, part: int) -> np.ndarray:
        """[t + 1, fingerprint]: probes and candidates of the part at threshold t = -1..distance."""
        most = self.distance
        exact = None
        for near, block in zip(self.near[part], self.blocks[part]):
            own = near[:, block_values(fps, block)]
            if exact is None:
                exact = own
            else:
                exact = np.array([sum(exact[a] * own[t - a] for a in range(t + 1))
                                  for t in range(most + 1)]) / self.total
        candidates = np.cumsum(exact, axis=0)
        probes = np.cumsum([len(m) for m in self.masks[part]])[:, None] * self.probe_cost
        return np.concatenate([np.zeros((1, len(fps))), candidates + probes])

    def allocate(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds [part, fingerprint] of least cost, and that cost."""
        units = self.distance + 1
        best = np.full((units + 1, len(fps)), np.inf)
        best[0] = 0
        choices = []
        for part in range(len(self.blocks)):
            cost = self.costs(fps, part)
            options = np.stack([
                np.where(np.arange(units + 1)[:, None] >= u, np.roll(best, u, axis=0) + cost[u],
                         np.inf)
                for u in range(units + 1)
            ])
            choices.append(options.argmin(0))
            best = options.min(0)
        left = np.full(len(fps), units)
        at = np.arange(len(fps))
        thresholds = np.empty((len(self.blocks), len(fps)), np.int64)
        for part in reversed(range(len(self.blocks))):
            used = choices[part][left, at]
            thresholds[part] = used - 1
            left = left - used
        return thresholds, best[units]


    def probes(self, fps: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(part, t, rows, values): the values that rows of ``fps`` probe in a part, at t bits."""
        thresholds, _ = self.allocate(fps)
        for part in range(len(self.blocks)):
            own = self.values(fps, part)
            for t, masks in enumerate(self.masks[part]):
                on = np.flatnonzero(thresholds[part] >= t)
                for first in range(0, len(masks) if len(on) else 0, 64):
                    some = masks[first:first + 64]
                    yield part, t, np.repeat(on, len(some)), (own[on][:, None] ^ some).ravel()


def flips(width: int, most: int) -> list[np.ndarray]:
    """Masks of exactly t bits, t = 0..most; those of a wide part stop at 3 bits.

    A part that cannot be searched wider gets no such threshold, see ``plan_for``.
    """
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), t)], np.int64)
            for t in range(most + 1)]


def plan_for(fps: DataFrame, distance: int, probe_cost: float = PROBE_COST) -> Plan:
    """Four parts, or two where all fingerprints together are cheaper with two."""
    blocks = group_bits(agreement(fps))
    counts = histograms(fps, blocks)
    plans = [Plan(blocks, counts, distance, parts, probe_cost) for parts in (4, 2)]

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total = np.zeros(len(plans))
        for batch in batches:
            total += [plan.allocate(_unsigned(batch))[1].sum() for plan in plans]
        yield tuple(total.tolist())

    sums = arrow_map(fps, cost, "four double, two double").agg(F.sum("four"), F.sum("two")).first()
    return plans[1] if sums[0] is not None and sums[1] < sums[0] else plans[0]


# -- search --------------------------------------------------------------------

def close_pairs(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): pairs a < b of the distinct longs ``fps`` (fp) that differ in few bits, each once."""
    plan = plan_for(fps, distance)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _unsigned(batch)
            for part in range(len(plan.blocks)):
                yield _keyed(part, plan.values(values, part), batch.column("fp"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for part, _, on, keys in plan.probes(_unsigned(batch)):
                yield _keyed(part, keys, pa.array(fp[on]))

    schema = "part int, value long, fp long"
    stored = map_batches(fps, index, schema)
    probes = map_batches(fps, probe, schema).withColumnRenamed("fp", "other")
    differing = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    pairs = probes.join(stored, ["part", "value"]).filter(
        (F.col("fp") != F.col("other")) & (differing <= distance))
    return pairs.select(F.least("fp", "other").alias("a"),
                        F.greatest("fp", "other").alias("b")).distinct()


def _keyed(part: int, values: np.ndarray, fp: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(values), part, np.int32)), pa.array(values), fp],
        names=["part", "value", "fp"])


def near_duplicates(docs: DataFrame, size: int = 3, seed: int = 42,
                    distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents whose fingerprints link.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest doc_id
    reached over fingerprints at most ``distance`` bits apart, the own one
    included. Rows of one fingerprint are one node, so copies of a text are
    never paired. Texts are taken whole, however long; null, empty and blank
    ones have the fingerprint zero. Repeated ids give a row each; a null id is reached last and
    gives a null component only where all others are null. Empty in, empty out.
    """
    prints = written(fingerprints(docs, size, (seed,)).withColumnRenamed("f0", "fp"), "prints")
    return linked(prints, lambda fps: close_pairs(fps, distance)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def linked(prints: DataFrame, pairs: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``prints`` (doc_id, fp, ...) with the root and the smallest doc_id of their component."""
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(pairs(nodes.select("fp")))
    smallest = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    root: Column = F.coalesce("root", "fp")
    smallest = smallest.select("fp", root.alias("root"), "least")
    reach = smallest.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = smallest.select("fp", "root").join(reach, "root").select("fp", "root", "component_id")
    return prints.join(labels, "fp")


def drop_near_copies(docs: DataFrame, size: int = 3, seed: int = 42,
                     distance: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of documents whose
    fingerprints link, as in ``near_duplicates``, the one with the smallest doc_id, a null id last.

    Null, empty and blank texts have the fingerprint zero and are one group
    with what links to it. Texts are taken whole, however long. Of rows that
    agree in doc_id and text one stays. Other columns are kept whatever their
    names. Empty in, empty out.
    """
    key = F.xxhash64("doc_id", "text")
    keyed = docs.select("doc_id", "text", key.alias("key"))
    prints = written(fingerprints(keyed, size, (seed,), "key").withColumnRenamed("f0", "fp"),
                     "prints")
    groups = linked(prints, lambda fps: close_pairs(fps, distance))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    stay = groups.groupBy("root").agg(F.min(order).alias("best")).select("best.key")
    held = docs.select(key.alias("key"), F.struct("*").alias("row"))
    others = [F.col("row").getField(c) for c in docs.columns if c not in ("doc_id", "text")]
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.to_json(F.struct(
        F.lit(0), *others))))
    return held.join(stay, "key", "left_semi").withColumn("nth", nth).filter("nth = 1").select(
        "row.*")
