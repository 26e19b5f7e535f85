"""Burrows-Wheeler transforms of sets of strings, and their merge by interleave refinement.

Strings are rows of symbols, ranks 1, 2, ...; each ends in a sentinel of its
own, smaller than any symbol, in the order of the strings.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """The transform of some strings: symbols before the suffixes in their order.

    ``places`` says which suffix each row is, as a position in the strings laid
    end to end, a sentinel after each.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        """``symbols``: the strings with 0 for each sentinel; ``ends``: where the sentinels are."""
        self.strings = len(ends)
        rank = symbols.astype(np.int64) + len(ends)
        rank[ends] = np.arange(len(ends))
        rank = np.unique(rank, return_inverse=True)[1]
        step, size = 1, len(symbols)
        while True:
            after = np.zeros(size, np.int64)
            after[:-step or None] = rank[step:] + 1 if step < size else 0
            key = rank * (size + 2) + after
            self.places = np.argsort(key, kind="stable")
            ordered = key[self.places]
            new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = np.empty(size, np.int64)
            rank[self.places] = new
            if new[-1] == size - 1 or step >= size:
                break
            step *= 2
        before = np.concatenate([[0], symbols[:-1]])
        self.transform = before[self.places]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave the shards' suffixes by their first ``depth`` symbols.

    Returns (shard, place, common): for each row of the merged order the shard
    and place of its suffix, and the length of the prefix it has in common with
    the row above, ``depth`` where that is longer.

    The interleave begins with one shard after another. A pass reads the
    transforms in the order of the interleave and deals the rows to the buckets
    of their symbols, which is the order by one symbol more. No suffix is
    compared or sorted again. A row that first begins a bucket in pass k has
    k - 1 symbols in common with the one above.
    """
    transform = np.concatenate([s.transform for s in shards])
    small = transform.max(initial=0) < 1 << 16
    transform = transform.astype(np.uint16 if small else np.int32)
    owner = np.concatenate([np.full(len(s.transform), i, np.uint16) for i, s in enumerate(shards)])
    sentinels = np.concatenate([np.full(s.strings, i, np.uint16) for i, s in enumerate(shards)])
    size = len(owner)
    bucket = np.zeros(size, np.int32)
    common = np.full(size, depth, np.int32)
    begins = np.zeros(size, bool)
    for k in range(1, depth + 1):
        symbol = np.empty(size, transform.dtype)
        symbol[np.argsort(owner, kind="stable")] = transform
        rows = np.flatnonzero(symbol)
        rows = rows[np.argsort(symbol[rows], kind="stable")]
        moved, of, kept = owner[rows], symbol[rows], bucket[rows]
        first = np.ones(size, bool)
        n = len(sentinels)
        first[n + 1:] = (of[1:] != of[:-1]) | (kept[1:] != kept[:-1])
        new = np.concatenate([sentinels, moved])
        fresh = first & ~begins
        common[fresh] = k - 1
        if not fresh.any() and np.array_equal(new, owner):
            break
        owner, begins = new, first
        bucket = np.cumsum(first, dtype=np.int32)
    place = np.empty(size, np.int64)
    place[np.argsort(owner, kind="stable")] = np.concatenate([s.places for s in shards])
    return owner, place, common
