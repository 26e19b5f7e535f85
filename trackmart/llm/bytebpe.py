"""Byte-level BPE encoding and decoding by backtracking (operator 13).

A text is cut by the pattern of its vocabulary, and each cut is encoded by
itself. Bytes stand as Latin-1 characters in an Aho-Corasick automaton of all
tokens, which gives the longest token that begins at every byte in one pass. A
list of tokens is what the merges lead to if and only if any two neighbours are
what the merges make of their joined bytes: up to the first merge across a
border the two sides are merged as if they were alone. So tokens are taken from
the left, the longest first; a token that does not fit the one before gives way
to the longest token that begins it, and a byte from which none fits is closed
for good, as only one list of tokens leads to it. Whether two tokens fit is
worked out once, by merging, and kept; every byte is opened and closed once.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackmart.llm.common import map_batches, small_batches

#: Cuts and words of more characters are not kept in a worker's tables; as many of either are kept
#: at most, and as many pairs of neighbours.
KEPT_CHARS, KEPT_WORDS, KEPT_PAIRS = 64, 400_000, 500_000
ID = np.dtype("<i4")
ENCODED = "doc_id long, ids array<int>"
DECODED = ENCODED + ", data binary"


class Known(dict):
    """Ids by text, worked out on demand; the last ``KEPT_WORDS`` to twice as many are kept, of
    texts that are not too long."""

    def __init__(self, fill: Callable[[str], bytes]):
        super().__init__()
        self.fill = fill
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        return self.keep(key, self.fill(key) if found is None else found)

    def keep(self, key: str, ids: bytes) -> bytes:
        if len(key) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[key] = ids
        return ids


#: Of a token: the ranks of its merges in order, and its first and last part before each of them
#: and at the end.
Edges = tuple[list[int], list[bytes], list[bytes]]


class ByteBPE:
    """Exact merges of a rank file, and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([byte]) not in ranks for byte in range(256)):
            raise ValueError("the vocabulary has no token for some byte")
        self.ranks = ranks
        most = max(ranks.values()) + 1
        self.spelling = [b""] * most
        for token, rank in ranks.items():
            self.spelling[rank] = token
        self.sizes = [len(token) for token in self.spelling]
        self.lengths = np.array(self.sizes, np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.cut = pattern_of(pattern).findall
        self.spaced = cuts_at_spaces(pattern)
        self.cuts, self.words = Known(self._cut), Known(self._word)
        # For every token, and at the end for none before, whether another one can follow.
        self.follows: list[dict[int, bool]] = [{} for _ in range(most + 1)]
        self.pairs = 0
        self.grown: dict[int, Edges | None] = {}
        self.shorter = [-2] * most  # the longest shorter token that begins a token; -2: not known

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        """Read a file of lines with a token in base64 and its rank."""
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def merges(self, data: bytes) -> Iterator[tuple[int, list[bytes]]]:
        """Merge neighbours of the lowest rank, the leftmost first: each rank and what is left then."""
        ranks, never = self.ranks, len(self.spelling)
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i:i + 2], never) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) < never:
            at = pairs.index(best)
            parts[at:at + 2] = [self.spelling[best]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], never)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], never)
            yield best, parts

    def merged(self, data: bytes) -> list[int]:
        parts = [data[i:i + 1] for i in range(len(data))]
        for _, parts in self.merges(data):
            pass
        return [self.ranks[part] for part in parts]

    def edges(self, token: int) -> Edges | None:
        """How the outer parts of a token grow as its bytes are merged; None if they do not make it."""
        if token not in self.grown:
            data = self.spelling[token]
            steps = [(-1, data[:1], data[-1:])] + [
                (rank, parts[0], parts[-1]) for rank, parts in self.merges(data)]
            made, firsts, lasts = (list(column) for column in zip(*steps))
            whole = firsts[-1] == data
            self.grown[token] = ([*made[1:], len(self.spelling)], firsts, lasts) if whole else None
        return self.grown[token]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before``, or begin if that is -1: whether the merges of
        their joined bytes, those of either side in order, never take one across the border."""
        if self.pairs >= KEPT_PAIRS:
            for known in self.follows:
                known.clear()
            self.pairs = 0
        left, right = self.edges(before) if before >= 0 else None, self.edges(token)
        fits = right is not None and (before < 0 or left is not None and self._apart(left, right))
        self.follows[before][token] = fits
        self.pairs += 1
        return fits

    def _apart(self, left: Edges, right: Edges) -> bool:
        (left_ranks, _, lasts), (right_ranks, firsts, _) = left, right
        never, i, j = len(self.spelling), 0, 0
        while True:
            across = self.ranks.get(lasts[i] + firsts[j], never)
            one, other = left_ranks[i], right_ranks[j]
            # Of equal ranks the leftmost goes first.
            if across < one and across <= other and across < never:
                return False
            if one <= other:
                if one == never:
                    return True
                i += 1
            else:
                j += 1

    def beginning(self, token: int) -> int:
        """The longest shorter token that begins ``token``, or -1."""
        data, ranks = self.spelling[token], self.ranks
        ends = range(len(data) - 1, 0, -1)
        found = next((ranks[data[:end]] for end in ends if data[:end] in ranks), -1)
        self.shorter[token] = found
        return found

    def encode_cut(self, data: bytes) -> list[int]:
        """The tokens of one cut: the token that it is, or what the merges of its bytes give."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, sizes, follows, shorter = len(data), self.sizes, self.follows, self.shorter
        longest = [0] * n  # of the tokens that begin at a byte; later ends are longer
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - sizes[token]] = token
        out: list[int] = []
        open_ = bytearray(b"\x01") * (n + 1)
        at, before, token, can = 0, -1, longest[0], follows[-1]
        while True:
            end = at + sizes[token]
            if open_[end]:
                fits = can.get(token)
                if self.fits(before, token) if fits is None else fits:
                    out.append(token)
                    if end == n:
                        return out
                    at, before, token, can = end, token, longest[end], follows[token]
                    continue
            last, token = token, shorter[token]
            if token == -2:
                token = self.beginning(last)
            while token < 0:  # nothing fits here: back to the token before, and shorten that
                open_[at] = 0
                last = out.pop()
                at -= sizes[last]
                before, token = out[-1] if out else -1, shorter[last]
                can = follows[before]
                if token == -2:
                    token = self.beginning(last)

    def _cut(self, cut: str) -> bytes:
        return array("i", self.encode_cut(cut.encode())).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word with a space before it; letters are one cut."""
        return self._cut(" " + word) if word.isalpha() else self._by_cuts(" " + word)

    def _by_cuts(self, text: str) -> bytes:
        """Ids of a text by the pattern."""
        words, parts = self.words, []
        for cut in self.cut(text):
            if cut[0] != " " or len(cut) == 1:
                parts.append(self.cuts[cut])
            else:  # as a word, but one whose cut is known
                found = words.get(cut[1:]) or words.older.get(cut[1:])
                parts.append(found or words.keep(cut[1:], self._cut(cut)))
        return b"".join(parts)

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers; none for null or empty."""
        if not text:
            return b""
        if not self.spaced:
            return self._by_cuts(text)
        first, *rest = _words(text)
        return b"".join([self._by_cuts(first), *map(self.words.__getitem__, rest)])

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, special tokens being ordinary text; none for null or empty."""
        return np.frombuffer(self.encode_bytes(text), ID).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelling.__getitem__, ids))


# -- the pattern ----------------------------------------------------------------

def cuts_at_spaces(pattern: str) -> bool:
    """Whether a lone space between other characters always begins a cut of its own.

    So it is with patterns in which a space stands only as an optional first
    character before classes without white space.
    """
    parts = pattern.split("|")
    spaces = (r"\s+(?!\S)", r"\s+")
    plain = re.compile(r"'\w+| \?(?:\\p\{[LN]\}|\[\^\\s(?:\\p\{[LN]\})*\])\+")
    return tuple(parts[-2:]) == spaces and all(plain.fullmatch(part) for part in parts[:-2])


def _words(text: str) -> list[str]:
    """The text cut before every lone space that has other characters on both sides, without
    those spaces."""
    words = text.split(" ")
    if all(word and not word[0].isspace() and not word[-1].isspace() for word in words):
        return words
    joined = [words[0]]
    for word in words[1:]:
        last = joined[-1]
        if not last or not word or last[-1].isspace() or word[0].isspace():
            joined[-1] = f"{last} {word}"
        else:
            joined.append(word)
    return joined


CLASS = re.compile(r"\\p\{\w+\}|\\[sS]|\\.|[\[\]]|.", re.S)


def pattern_of(pattern: str) -> re.Pattern[str]:
    r"""The pattern for Python's ``re``: \p{..} and \s as ranges of characters.

    Which characters a class has depends on the Unicode version; the ranges
    are those of the library whose cuts have to come out.
    """
    out, inside = [], False
    for part in CLASS.findall(pattern):
        if part in "[]":
            inside = part == "["
        elif part.startswith((r"\p", r"\s", r"\S")):
            ranges = _ranges(part.replace(r"\S", r"\s"))
            part = ranges if inside else f"[{'^' * (part == chr(92) + 'S')}{ranges}]"
        out.append(part)
    return re.compile("".join(out))


@functools.cache
def _ranges(name: str) -> str:
    """The characters of a class, as ranges: those that the library does not skip."""
    import tiktoken

    single = {bytes([byte]): byte for byte in range(256)}
    finder = tiktoken.Encoding(f"class {name}", pat_str=f"{name}+", mergeable_ranks=single,
                               special_tokens={})
    everything = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    text = bytes(finder.encode_ordinary(everything)).decode()
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    first = np.flatnonzero(np.diff(codes, prepend=-2) != 1)
    last = np.append(first[1:], len(codes)) - 1
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(codes[first], codes[last]))


# -- documents ------------------------------------------------------------------

def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@functools.cache
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One encoder for each worker process, so that tasks share its tables."""
    return ByteBPE.load(path, pattern)


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def encode_documents(docs: DataFrame, path: str | None = None,
                     pattern: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text).

    A null or empty text has no ids. Texts are taken whole, however long, and
    repeated rows and ids, null ids too, are encoded alike; strings of special
    tokens are ordinary text. Other columns of ``docs`` are ignored. Empty in,
    empty out.
    """
    small_batches(docs.sparkSession)
    path, pattern = path or rank_file(), pattern or public_pattern()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = byte_bpe(path, pattern)
        for batch in batches:
            found = [tool.encode_bytes(text) for text in batch.column("text").to_pylist()]
            flat = np.frombuffer(b"".join(found), ID)
            sizes = np.array([len(f) // ID.itemsize for f in found], np.int64)
            ids = _lists(pa.array(flat, pa.int32()), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), ids], names=["doc_id", "ids"])

    return map_batches(docs.select("doc_id", "text"), rows, ENCODED)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, data): the bytes that the ids of each row spell.

    A null list spells nothing; an id that is not of the vocabulary raises an
    IndexError. Lists are taken whole; repeated rows are decoded alike and
    other columns ignored. Empty in, empty out.
    """
    small_batches(encoded.sparkSession)
    path, pattern = path or rank_file(), public_pattern()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = byte_bpe(path, pattern)
        for batch in batches:
            lists = batch.column("ids")
            data = [tool.decode(ids.tolist()) for ids in _arrays(lists)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), lists.cast(pa.list_(pa.int32())),
                 pa.array(data, pa.binary())], names=["doc_id", "ids", "data"])

    return map_batches(encoded.select("doc_id", "ids"), rows, DECODED)


def _arrays(lists: pa.ListArray) -> Iterator[np.ndarray]:
    ends = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    nulls = lists.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(lists)):
        yield values[:0] if nulls[i] else values[ends[i]:ends[i + 1]]
