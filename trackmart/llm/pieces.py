"""SentencePiece encoding and decoding (operator 10).

The best cut of a text into pieces has the largest sum of log scores. It is
found by Viterbi over a double-array trie of the pieces; characters that no
piece covers become byte pieces. No piece has a white-space marker after
another character, so the best cut of a text consists of those of its words,
each with the markers before it. Words are cut many at a time in numpy and
kept in a table.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackmart.llm.common import map_batches, small_batches

MARK = "▁"
_MARK = MARK.encode()
#: A word with more bytes is cut on its own.
LONG = 96


class Trie:
    """A double-array trie over bytes: the child of state s by byte c is t = base[s] + c + 1,
    if check[t] == s."""

    def __init__(self, pieces: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ids = [-1]
        for piece, number in pieces.items():
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ids.append(-1)
                node = children[node][byte]
            ids[node] = number
        size = 2 * len(children) + 1024
        base, check, value = [0] * size, [-1] * size, [-1] * size
        free_from = wide_from = 257  # past any code, so that every cell can be reached
        place = {0: 0}
        check[0] = -2
        for node in range(len(children)):  # parents come before their children
            state, codes = place[node], sorted(c + 1 for c in children[node])
            value[state] = ids[node]
            if not codes:
                continue
            # A lone child takes the first free cell; several look on from where the last
            # such node found room, as the cells before are too full to try again.
            while check[free_from] != -1:
                free_from += 1
            start = max((free_from if len(codes) == 1 else wide_from) - codes[0], 0)
            while True:
                if start + 300 >= len(check):
                    base += [0] * size
                    check += [-1] * size
                    value += [-1] * size
                if all(check[start + c] == -1 for c in codes):
                    break
                start += 1
            base[state] = start
            if len(codes) > 1:
                wide_from = start + codes[0]
            for byte, child in children[node].items():
                check[start + byte + 1] = state
                place[child] = start + byte + 1
        pad = [0] * 300
        self.base = np.array(base + pad, np.int32)
        self.check = np.array(check + [-1] * 300, np.int32)
        self.value = np.array(value + [-1] * 300, np.int32)

    @functools.cached_property
    def lists(self) -> tuple[list[int], list[int], list[int]]:
        return self.base.tolist(), self.check.tolist(), self.value.tolist()


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


class Pieces:
    """The pieces of a model with their log scores, and the search over them.

    ``scores`` of a BPE file are ranks of merges, not log probabilities. They
    are taken as a log score by the law of Zipf, -log(rank + 2), for a rank
    counted from 0; those of a unigram file are taken as they are.
    """

    def __init__(self, texts: Sequence[str], scores: Sequence[float], kinds: Sequence[int],
                 ranks: bool):
        self.texts = list(texts)
        # Kinds of the file format: 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte.
        normal = [i for i, kind in enumerate(kinds) if kind in (1, 4) and texts[i]]
        self.scores = np.full(len(texts), -1e9)
        for i in normal:
            self.scores[i] = -np.log(2.0 - scores[i]) if ranks else scores[i]
        self.bytes_ = np.full(256, -1, np.int64)
        for i, kind in enumerate(kinds):
            if kind == 6:
                self.bytes_[int(texts[i][1:-1], 16)] = i
        if (self.bytes_ < 0).any():
            raise ValueError("the model has no byte fallback")
        encoded = {texts[i].encode(): i for i in normal}
        if any(MARK in texts[i].lstrip(MARK) for i in normal):
            raise ValueError("a piece has a white-space marker after another character")
        self.trie = Trie(encoded)
        self.longest = max(map(len, encoded), default=1)
        #: A character that no piece covers costs more than any piece, as in unigram models.
        self.unknown = min((float(self.scores[i]) for i in normal), default=0.0) - 10.0
        self.table: dict[bytes, bytes] = {}
        self.piece_bytes = [b""] * len(texts)
        for i in normal:
            self.piece_bytes[i] = texts[i].encode()
        for byte, i in enumerate(self.bytes_):
            self.piece_bytes[i] = bytes([byte])

    @classmethod
    def load(cls, path: str, ranks: bool | None = None) -> Pieces:
        """Read a model file: field 1 repeats a piece (1 text, 2 score, 3 kind); in field 2,
        field 3 is the kind of model, 1 for unigram and 2 for BPE."""
        with open(path, "rb") as file:
            return cls.parse(file.read(), ranks)

    @classmethod
    def parse(cls, data: bytes, ranks: bool | None = None) -> Pieces:
        texts, scores, kinds, model = [], [], [], 1
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                texts.append(piece.get(1, b"").decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, 1))
            elif field == 2:
                model = dict(_fields(value)).get(3, 1)
        return cls(texts, scores, kinds, model == 2 if ranks is None else ranks)

    # -- search ---------------------------------------------------------------

    def cut_one(self, word: bytes) -> list[int]:
        """Viterbi over one word, byte by byte; cuts fall on characters, as pieces do."""
        base, check, value = self.trie.lists
        scores, n = self.scores, len(word)
        best = [-1e300] * (n + 1)
        best[0] = 0.0
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        at = 0
        while at < n:
            here, state = best[at], 0
            width = _width(word[at])
            single = False
            for end in range(at, n):
                child = base[state] + word[end] + 1
                if check[child] != state:
                    break
                state = child
                piece = value[state]
                if piece >= 0:
                    if end + 1 - at == width:
                        single = True
                    total = here + scores[piece]
                    if total > best[end + 1]:
                        best[end + 1], back[end + 1] = total, (at, piece)
            if not single:
                end = min(at + width, n)
                if here + self.unknown > best[end]:
                    best[end], back[end] = here + self.unknown, (at, -1)
            at += width
        return self._trace(word, back)

    def _trace(self, word: bytes, back: list[tuple[int, int]]) -> list[int]:
        out, end = [], len(word)
        while end > 0:
            start, piece = back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(int(self.bytes_[b]) for b in reversed(word[start:end]))
            end = start
        return out[::-1]

    def cut_many(self, words: list[bytes]) -> list[list[int]]:
        """The ids of many words."""
        return [np.frombuffer(ids, "<u4").tolist() for ids in self.cut_packed(words)]

    def cut_packed(self, words: list[bytes]) -> list[bytes]:
        """Viterbi over many words at once: a step for each position and length of piece.

        The ids of each word come as little-endian unsigned 32-bit integers.
        """
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        most = int(lengths[0])
        wide = most + 1
        # A row of codes for each word; the code 0 behind it leads to no child of any state.
        held = np.arange(wide) < lengths[:, None]
        codes = np.zeros(held.shape, np.int32)
        codes[held] = np.frombuffer(b"".join([words[i] for i in order.tolist()]), np.uint8)
        codes[held] += 1
        codes = codes.ravel()
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        best = np.full(len(codes), -1e300)
        start = np.zeros(len(codes), np.int32)
        piece = np.full(len(codes), -1, np.int32)
        first_cells = np.arange(len(words)) * wide
        best[first_cells] = 0
        alive = np.searchsorted(-lengths, -np.arange(most), side="left")  # rows longer than p
        for at in range(most):
            cells = first_cells[:alive[at]] + at
            lead = codes.take(cells) - 1
            begins = (lead & 0xC0) != 0x80
            if not begins.all():
                cells, lead = cells[begins], lead[begins]
                if not len(cells):
                    continue
            width = _WIDTHS.take(lead)
            here = best.take(cells)
            single = np.zeros(len(cells), bool)
            live, state = np.arange(len(cells)), np.zeros(len(cells), np.int32)
            for size in range(1, min(self.longest, most - at) + 1):
                child = base.take(state) + codes.take(cells.take(live) + (size - 1))
                ok = np.flatnonzero(check.take(child) == state)
                live, state = live.take(ok), child.take(ok)
                if not len(live):
                    break
                found = value.take(state)
                on = np.flatnonzero(found >= 0)
                if not len(on):
                    continue
                who, what = live.take(on), found.take(on)
                single[who[width.take(who) == size]] = True
                total = here.take(who) + self.scores.take(what)
                ends = cells.take(who) + size
                better = np.flatnonzero(total > best.take(ends))
                ends = ends.take(better)
                best[ends] = total.take(better)
                start[ends] = at
                piece[ends] = what.take(better)
            lone = np.flatnonzero(~single)
            if len(lone):
                row = cells[lone] // wide
                ends = row * wide + np.minimum(at + width[lone], lengths[row])
                total = here[lone] + self.unknown
                better = total > best[ends]
                ends = ends[better]
                best[ends] = total[better]
                start[ends] = at
                piece[ends] = -1
        return self._trace_many(order, lengths, codes, start, piece)

    def _trace_many(self, order: np.ndarray, lengths: np.ndarray, codes: np.ndarray,
                    start: np.ndarray, piece: np.ndarray) -> list[bytes]:
        """The ids on the best ways through the rows of ``codes``, by the words' own order."""
        wide = len(codes) // len(order)
        rows, ends, steps = np.arange(len(order)), lengths, []
        while len(rows):
            more = ends > 0
            rows, ends = rows[more], ends[more]
            cells = rows * wide + ends
            from_ = start[cells]
            steps.append((rows, from_, ends - from_, piece[cells]))
            ends = from_
        rows, from_, sizes, ids = map(np.concatenate, zip(*steps))
        by = np.argsort(order[rows] * wide + from_)
        rows, from_, sizes, ids = rows[by], from_[by], sizes[by], ids[by]
        if (ids < 0).any():  # a character that no piece covers becomes its bytes
            times = np.where(ids < 0, sizes, 1)
            place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            rows, from_, ids = (np.repeat(x, times) for x in (rows, from_, ids))
            lone = np.flatnonzero(ids < 0)
            code = codes[rows[lone] * wide + from_[lone] + place[lone]]
            ids[lone] = self.bytes_[code - 1]
        data = ids.astype("<u4").tobytes()
        bounds = [0, *(4 * np.cumsum(np.bincount(order[rows], minlength=len(order)))).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    # -- texts ----------------------------------------------------------------

    def encode_batch(self, texts: Sequence[str | None], most: int = 400_000) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; none for null or empty.

        A marker stands before the text and for every space; nothing else is
        changed, so that decoding gives the text back.
        """
        split = [_words(text) for text in texts]
        table = self.table
        if len(table) > most:
            table.clear()
        missing = list({w for words in split for w in words if w not in table})
        # Words of like length are cut together, as the longest gives the number of steps.
        short = sorted([w for w in missing if len(w) <= LONG], key=len)
        for first in range(0, len(short), 5_000):
            some = short[first:first + 5_000]
            table.update(zip(some, self.cut_packed(some)))
        for word in missing:
            if len(word) > LONG:
                table[word] = array("I", self.cut_one(word)).tobytes()
        out = [b"".join([table[w] for w in words]) for words in split]
        for word in missing:  # long words are not worth keeping
            if len(word) > LONG:
                del table[word]
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of some ids: pieces and bytes in a row, markers back to spaces, less the first."""
        joined = b"".join(map(self.piece_bytes.__getitem__, ids))
        text = joined.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at:at + size], at + size
        yield key >> 3, value


_WIDTHS = np.ones(256, np.int64)
_WIDTHS[0xC0:0xE0], _WIDTHS[0xE0:0xF0], _WIDTHS[0xF0:] = 2, 3, 4


def _width(byte: int) -> int:
    return 1 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


def _words(text: str | None) -> list[bytes]:
    """The text with markers for spaces, cut before every run of markers."""
    if not text:
        return []
    marked = (" " + text).replace(" ", MARK).encode()
    if _MARK + _MARK in marked:
        return _runs(marked)
    return [_MARK + word for word in marked.split(_MARK)[1:]]


def _runs(marked: bytes) -> list[bytes]:
    words, run = [], b""
    for part in marked.split(_MARK)[1:]:
        run += _MARK
        if part:
            words.append(run + part)
            run = b""
    if run:
        words.append(run)
    return words


@functools.cache
def piece_model(path: str) -> Pieces:
    """One model for each worker process, so that tasks share its table."""
    return Pieces.load(path)


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


ENCODED = "doc_id long, n_tokens long, ids_crc32 long, ids array<int>, text_back boolean"


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, ids, text_back) of every document.

    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit
    integers; ``text_back`` says whether decoding the ids gave the text. A
    null or empty text has no ids and comes back. A text that has the marker
    itself comes back with a space in its place, and says so. Other columns of
    ``docs`` are ignored; repeated rows are encoded alike. Empty in, empty out.
    """
    small_batches(docs.sparkSession)
    path = path or model_file()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            encoded = model.encode_batch(texts)
            back = [model.decode(np.frombuffer(data, "<u4").tolist()) == (text or "")
                    for text, data in zip(texts, encoded)]
            sizes = np.array([len(data) // 4 for data in encoded], np.int64)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(encoded), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes),
                 pa.array([zlib.crc32(data) for data in encoded], pa.int64()), ids,
                 pa.array(back, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_crc32", "ids", "text_back"])

    return map_batches(docs.select("doc_id", "text"), rows, ENCODED)
