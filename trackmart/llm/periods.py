"""Periodic runs of words by online dyadic square catching (operator 11).

Words are appended one by one. On level k every completed block of 2**k words
gets a catcher, which waits for the block to come again p words later, 2**k <=
p < 2**(k+1): with each appended word it advances the longest suffix of the
text that begins its block. Where the block came again, the agreement at
distance p is followed back to where it began; once it spans 2p words, a
square is caught. It grows with each word that goes on with it and ends as a
run: squares of one period that overlap merge into one. A run of at least four
periods holds a whole block of its level, so none escapes.

Catchers are set only where a run of their level can be. After its first
period, every word of a run has stood at most p words before; so a run of level
k needs 3 * 2**k words in a row that each came back within 2**(k+1) words. Other
stretches have no such run, and prose has next to none. Blocks inside a run of
a shorter period catch only its multiples and get no catcher either.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackmart.llm.common import arrow_map, rows_of, small_batches

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
NEVER = 1 << 40
WIDTH = 4  # bytes of a word's number

RUNS = ("doc_id long, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string")


class Catcher:
    """Waits for a block of words to come again."""

    __slots__ = ("start", "block", "back", "state")

    def __init__(self, words: list[int], start: int, size: int):
        self.start, self.block, self.state = start, words[start:start + size], 0
        self.back = back = [0] * size  # of each beginning of the block, its longest border
        state = 0
        for i in range(1, size):
            while state and self.block[state] != self.block[i]:
                state = back[state - 1]
            if self.block[state] == self.block[i]:
                state += 1
            back[i] = state

    def append(self, word: int) -> bool:
        """Take the next word; whether the block has just come again."""
        state, block = self.state, self.block
        if state == len(block):
            state = self.back[state - 1]
        while state and block[state] != word:
            state = self.back[state - 1]
        if block[state] == word:
            state += 1
        self.state = state
        return state == len(block)


class Runs:
    """The runs of one text, level by level."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        last: dict[bytes, int] = {}
        came: list[int] = []  # how many words ago the same word stood
        for i, word in enumerate(words):
            came.append(i - last.get(word, -NEVER))
            last[word] = i
        self.came = np.array(came, np.int64)
        self.texts = words

    def find(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run, by start and period."""
        if self.n < LEAST_WORDS:
            return []
        known = np.concatenate([[-1], np.flatnonzero(self.came >= NEVER), [self.n]])
        longest = int(np.diff(known).max()) - 1  # words in a row that all stood before
        size, ready, found = 1, False, {}
        while least_tail(size) <= longest:
            for lo, hi in self._zones(size):
                if not ready:
                    self._number()
                    ready = True
                for start, end, period in self._caught(size, lo, hi):
                    found[start, end] = min(period, found.get((start, end), period))
            for (start, end), period in found.items() if ready else ():
                if size <= period:
                    self._cover(start, end, period)
            size *= 2
        runs = [(start, end - start, period) for (start, end), period in found.items()
                if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period)]
        return sorted(runs, key=lambda run: (run[0], run[2]))

    def _zones(self, size: int) -> list[tuple[int, int]]:
        """Where runs with periods of ``size`` to 2 * ``size`` - 1 words can be."""
        edges = np.concatenate([[-1], np.flatnonzero(self.came >= 2 * size), [self.n]])
        wide = np.flatnonzero(np.diff(edges) - 1 >= least_tail(size)).tolist()
        return [(max(0, int(edges[i]) + 2 - 2 * size), int(edges[i + 1])) for i in wide]

    def _number(self) -> None:
        numbers: dict[bytes, int] = {}
        self.words = [numbers.setdefault(word, len(numbers)) for word in self.texts]
        self.data = np.array(self.words, np.uint32).tobytes()
        # Of the squares found so far: where the one that reaches farthest ends, and its period.
        self.until = np.zeros(self.n, np.int64)
        self.by = np.ones(self.n, np.int64)

    def _cover(self, start: int, end: int, period: int) -> None:
        farther = np.flatnonzero(self.until[start:end] < end) + start
        self.until[farther], self.by[farther] = end, period

    def _same(self, one: int, other: int, length: int) -> bool:
        data = self.data
        return (data[WIDTH * one:WIDTH * (one + length)]
                == data[WIDTH * other:WIDTH * (other + length)])

    def _agree_back(self, one: int, other: int) -> int:
        """How many words before ``one`` equal those before ``other``; one < other."""
        low, step = 0, 1  # ``low`` words agree
        while low + step <= one and self._same(one - low - step, other - low - step, step):
            low, step = low + step, 2 * step
        while step:
            if low + step <= one and self._same(one - low - step, other - low - step, step):
                low += step
            step //= 2
        return low

    def _caught(self, size: int, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, period) of the squares that catchers of one size find in words lo to hi."""
        words, catchers = self.words, deque()
        open_: dict[int, int] = {}  # squares that still grow: period, start
        due: dict[int, set[tuple[int, int]]] = {}  # by the last word of the square to be
        for t in range(lo, hi):
            word = words[t]
            if open_:
                for period in [p for p in open_ if words[t - p] != word]:
                    yield open_.pop(period), t, period
            if due:
                for start, period in due.pop(t, ()):
                    if period not in open_ and self._same(start, start + period, period):
                        open_[period] = start
            if catchers and t + 1 - catchers[0].start >= 3 * size:
                catchers.popleft()
            for catcher in catchers:
                if catcher.append(word):
                    at = catcher.start
                    period = t + 1 - size - at
                    if period in open_ or self.until[at] > t and period % self.by[at] == 0:
                        continue
                    start = at - self._agree_back(at, at + period)
                    if start + 2 * period <= t + 1:
                        open_[period] = start
                    else:
                        due.setdefault(start + 2 * period - 1, set()).add((start, period))
            if (t + 1 - lo) % size == 0:
                at = t + 1 - size
                inside = self.until[at] >= min(at + 3 * size, hi) and self.by[at] <= size
                if not inside:
                    catchers.append(Catcher(words, at, size))
        for period, start in open_.items():
            yield start, hi, period


def least_tail(size: int) -> int:
    """Words of a run after its first period, for periods of ``size`` words and more."""
    return max((LEAST_PERIODS - 1) * size, LEAST_WORDS - size)


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of some words, by start and period.

    A run is a stretch of words in which words ``period`` apart are the same,
    for no smaller period, of at least ``LEAST_WORDS`` words and
    ``LEAST_PERIODS`` periods, which no word beside it goes on with.
    """
    return Runs(words).find()


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those that a run holds after its first period."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text).

    Words are runs of characters other than ASCII white space. ``runs`` has
    (start, length, period) in words by start and period; ``collapsed`` is the
    text's words joined by one space, without those that a run repeats. A text
    that is null, empty or blank has no words, no runs and an empty collapsed
    text. Texts are taken whole, however long; memory grows with the longest
    one. Repeated rows and ids, null ids too, are each answered alike. Other
    columns of ``docs`` are ignored. Empty in, empty out.
    """
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            words = (text or "").encode().split()
            runs = runs_of(words)
            kept = without_repeats(words, runs) if runs else words
            spans = [dict(zip(("start", "length", "period"), run)) for run in runs]
            yield doc_id, len(words), spans, b" ".join(kept).decode()

    return arrow_map(docs.select("doc_id", "text"), rows, RUNS)
