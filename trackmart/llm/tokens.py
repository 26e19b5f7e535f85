"""Token ids in a binary format of directly addressable codes (operator 1).

A table of segments holds the ids of all documents in order. In a segment an
id is cut into chunks of 8, 8 and 16 bits. Level 0 has the lowest chunk of
every id; a bitmap says which ids go on, and level 1 has the next chunk of
those alone. The place of an id on the next level is the rank of its bit, read
from a directory with a count for every 512 bits. So any id is found from its
position by a fixed number of look-ups, and nothing is decoded block by block.
"""

from __future__ import annotations

import functools
import re
import string
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_map, rows_of, small_batches

WIDTHS = (8, 8, 16)
RANK_BITS = 512
SEGMENT = (
    "shard int, seq int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "codes array<binary>, bitmaps array<binary>, ranks array<binary>"
)
TYPES = {8: np.dtype("u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}


def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of unsigned 32-bit ids."""
    codes, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    for level, width in enumerate(WIDTHS):
        codes.append((rest & np.uint32((1 << width) - 1)).astype(TYPES[width]).tobytes())
        rest = rest >> np.uint32(width)
        if level == len(WIDTHS) - 1:
            break
        goes_on = rest > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        counts = np.bitwise_count(bits).reshape(-1, RANK_BITS // 8).sum(1, dtype=np.uint32)
        bitmaps.append(bits.tobytes())
        ranks.append((np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4").tobytes())
        rest = rest[goes_on]
        if not len(rest):
            break
    return codes, bitmaps, ranks


class Segment:
    """Random access to the ids of one segment."""

    def __init__(self, codes: Sequence[bytes], bitmaps: Sequence[bytes], ranks: Sequence[bytes]):
        self.codes = [np.frombuffer(c, TYPES[w]) for c, w in zip(codes, WIDTHS)]
        self.words = [np.frombuffer(b, "<u8") for b in bitmaps]
        # The directory, brought from blocks to their words: bits set before each word.
        self.ranks = []
        for stored, words in zip(ranks, self.words):
            counts = np.bitwise_count(words).astype(np.int64).reshape(-1, RANK_BITS // 64)
            before = np.frombuffer(stored, "<u4")[:, None] + np.cumsum(counts, axis=1) - counts
            self.ranks.append(before.ravel())

    def __len__(self) -> int:
        return len(self.codes[0])

    def access(self, positions: np.ndarray) -> np.ndarray:
        """The ids at ``positions``, in any order and with repeats."""
        at = np.asarray(positions, dtype=np.int64)
        ids = self.codes[0][at].astype(np.uint32)
        open_ = np.arange(len(at))
        shift = 0
        for level, words in enumerate(self.words):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            on = (words[word] >> bit) & np.uint64(1) == 1
            at, word, bit, open_ = at[on], word[on], bit[on], open_[on]
            if not len(at):
                break
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            at = self.ranks[level][word] + np.bitwise_count(below)
            shift += WIDTHS[level]
            ids[open_] |= self.codes[level + 1][at].astype(np.uint32) << np.uint32(shift)
        return ids


# -- encoding -----------------------------------------------------------------

#: Pieces that the pre-tokenizer of word_bpe_49k.json cuts from plain ASCII text.
PLAIN = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9\s]+")
PRINTABLE = re.compile(rb"[\x21-\x7e]+")
#: What can stand around a word as one piece, and where the Latin letters end that lower-case and
#: compose in themselves.
MARKS, LATIN_END = string.punctuation.replace("'", ""), "\u0250"


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is
    printable, the next one from 256 on for the others."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {**{b: b for b in printable}, **{b: 256 + i for i, b in enumerate(others)}}


LETTERS = byte_letters()


class _Table(dict):
    """Results by key, filled on demand and emptied when ``most`` are held."""

    def __init__(self, fill: Callable[[bytes], bytes], most: int):
        super().__init__()
        self.fill, self.most = fill, most

    def __missing__(self, key: bytes) -> bytes:
        value = self.fill(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Ids of whole texts from a lower-casing word tokenizer.

    Its pre-tokenizer never joins characters across white space, so a text's
    ids are those of its words in order. Words are looked up in a table of at
    most ``most`` entries that the tokenizer fills. ASCII texts without an
    apostrophe or a special token are cut as the pre-tokenizer cuts them, and
    their pieces go to its BPE model directly, which skips the offsets; so are
    Latin words with marks around them.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = _Table(self._word, most)
        self.pieces = _Table(self._piece, most)

    def _word(self, word: bytes) -> bytes:
        if self._is_plain(word):
            return b"".join(map(self.pieces.__getitem__, PLAIN.findall(word.lower())))
        text = word.decode()
        core = text.strip(MARKS)
        if core and "'" not in text and "<|" not in text and max(core) < LATIN_END:
            lower = core.lower()
            if lower.isalpha():  # letters are one piece, and so are the marks on either side
                before, _, after = text.partition(core)
                ids = self._model(lower.encode().decode("latin-1").translate(LETTERS))
                return b"".join([self.pieces[before.encode()] if before else b"", ids,
                                 self.pieces[after.encode()] if after else b""])
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _model(self, piece: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(piece)]).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        if PRINTABLE.fullmatch(piece):
            return self._model(piece.decode())
        ids = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    @staticmethod
    def _is_plain(text: bytes) -> bool:
        return text.isascii() and b"'" not in text and b"<|" not in text

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; none for null or empty."""
        if not text:
            return b""
        data = text.encode()
        if self._is_plain(data):
            return b"".join(map(self.pieces.__getitem__, PLAIN.findall(data.lower())))
        return b"".join(map(self.words.__getitem__, data.split()))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def word_encoder(name: str = "word_bpe_49k.json") -> WordEncoder:
    """One encoder for each worker process, so that tasks share its table."""
    return WordEncoder(tokenizer_file(name))


def write_tokens(
    docs: DataFrame, path: str, end_id: int = 2,
    encoder: Callable[[], WordEncoder] | None = None,
    segment_tokens: int = 1 << 20,
) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    Null ids come first; rows of one id follow each other by a hash of the
    text and then the text, so that a repeated id does not fill one task. A
    null or empty text has the end id alone. A segment takes documents until
    it holds ``segment_tokens`` ids and never splits one; a text is encoded
    whole, however long, and may be a segment of its own. Other columns of
    ``docs`` are ignored. An empty table gives no segment.
    """
    small_batches(docs.sparkSession)
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text", tie.alias("tie")).repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie", "text")
    end = array("I", [end_id]).tobytes()
    encoder = encoder or word_encoder

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shard, seq, tool = TaskContext.get().partitionId(), 0, encoder()
        doc_ids: list = []
        lengths: list[int] = []
        parts: list[bytes] = []
        total = 0

        def segment() -> tuple:
            ids = np.frombuffer(b"".join(parts), np.uint32)
            return (shard, seq, total, doc_ids, lengths, *pack(ids))

        for doc_id, text in rows_of(batches, "doc_id", "text"):
            ids = tool.encode(text) + end
            doc_ids.append(doc_id)
            lengths.append(len(ids) // 4)
            parts.append(ids)
            total += len(ids) // 4
            if total >= segment_tokens:
                yield segment()
                seq, doc_ids, lengths, parts, total = seq + 1, [], [], [], 0
        if doc_ids:
            yield segment()

    arrow_map(ordered, segments, SEGMENT, batch_rows=1).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(shard, seq, base): ids before each segment.

    Only the totals of the shards pass through one task, a row for each task
    of the writer.
    """
    sizes = segments.select("shard", "seq", "n_tokens")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_base")
    )
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(shards, "shard").select(
        "shard", "seq",
        (F.col("shard_base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("base"),
    )


def read_documents(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """The documents of a table of segments: doc_id, start, n_tokens, ids_crc32 [, ids].

    Every id is read by its position.
    """
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        names = ("shard", "seq", "doc_ids", "doc_tokens", "codes", "bitmaps", "ranks")
        for shard, seq, doc_ids, lengths, *levels in rows_of(batches, *names):
            segment, at = Segment(*levels), 0
            for doc_id, length in zip(doc_ids, lengths):
                ids = segment.access(np.arange(at, at + length)).astype("<u4")
                row = (shard, seq, doc_id, at, length, zlib.crc32(ids.tobytes()))
                yield (*row, ids.tolist()) if with_ids else row
                at += length

    schema = "shard int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"
    found = arrow_map(segments, unpack, schema + ", ids array<long>" * with_ids)
    placed = found.join(segment_starts(segments), ["shard", "seq"])
    return placed.select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids,
    )


def tokens_at(segments: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ids at ``wanted`` (doc_id, pos): doc_id, pos, token_id.

    A position outside its document gives no row. Only the wanted ids are
    read from a segment.
    """
    index = segments.select("shard", "seq", F.posexplode("doc_ids").alias("nth", "doc_id"),
                            "doc_tokens")
    before = F.aggregate(F.slice("doc_tokens", 1, F.col("nth")), F.lit(0).cast("long"),
                         lambda total, n: total + n)
    index = index.select("shard", "seq", "doc_id", before.alias("at"),
                         F.element_at("doc_tokens", F.col("nth") + 1).alias("n"))
    places = wanted.select("doc_id", "pos").join(index, "doc_id")
    places = places.filter((F.col("pos") >= 0) & (F.col("pos") < F.col("n"))).select(
        "shard", "seq", "doc_id", "pos", (F.col("at") + F.col("pos")).alias("place"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_ids, pos, places_, *levels in rows_of(
                batches, "doc_ids", "pos", "places", "codes", "bitmaps", "ranks"):
            ids = Segment(*levels).access(np.array(places_))
            yield from zip(doc_ids, pos, ids.tolist())

    grouped = places.groupBy("shard", "seq").agg(
        F.collect_list("doc_id").alias("doc_ids"), F.collect_list("pos").alias("pos"),
        F.collect_list("place").alias("places"))
    joined = grouped.join(segments.select("shard", "seq", "codes", "bitmaps", "ranks"),
                          ["shard", "seq"])
    return arrow_map(joined, look_up, "doc_id long, pos long, token_id long")
