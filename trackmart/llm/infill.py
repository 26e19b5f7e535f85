"""Fill-in-middle examples from seekable compressed frames (operator 12).

A text is stored as independent zstandard frames of a fixed number of
characters, with a directory of how many units, lines here, end before each
frame. Where a unit ends is found by a search in the directory and by unpacking
the one frame that holds the end. An example is then read from the frames in the
order of its form, a frame at a time, and its digest is taken as they pass.
"""

from __future__ import annotations

import functools
import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_map, rows_of, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FRAME_CHARS = 1 << 16
#: units: of the whole text; before[i]: units that end before frame i; marked: it has a marker.
STORED = ("doc_id long, units long, n_chars long, frame_chars int, marked boolean, "
          "before array<long>, frames array<binary>")
EXAMPLES = ("doc_id long, units long, form string, prefix_chars long, middle_chars long, "
            "output string, output_sha256 string")


# -- frames ---------------------------------------------------------------------

@functools.cache
def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


@functools.cache
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def pack(text: str, frame_chars: int) -> tuple[list[int], list[bytes]]:
    """The directory and the frames of a text; an empty text has none."""
    before, frames, ended = [], [], 0
    for first in range(0, len(text), frame_chars):
        part = text[first:first + frame_chars]
        before.append(ended)
        frames.append(_packer().compress(part.encode()))
        ended += part.count("\n")
    return before, frames


def unit_count(text: str) -> int:
    """Lines with their line feed, and what follows the last one."""
    return text.count("\n") + (text[-1:] not in ("", "\n"))


class Frames:
    """Random access to a stored text by units and characters."""

    def __init__(self, units: int, n_chars: int, frame_chars: int, before: Sequence[int],
                 frames: Sequence[bytes]):
        self.units, self.n_chars, self.frame_chars = units, n_chars, frame_chars
        self.before, self.frames = before, frames
        self.held: dict[int, str] = {}  # the last frames unpacked for a cut, two at most

    def _frame(self, number: int) -> str:
        text = self.held.get(number)
        return _unpacker().decompress(self.frames[number]).decode() if text is None else text

    def end_of(self, units: int) -> int:
        """Characters in the first ``units`` units; unpacks one frame at most."""
        if units <= 0:
            return 0
        if units >= self.units:
            return self.n_chars
        number = bisect_left(self.before, units) - 1
        text, at = self._frame(number), -1
        if len(self.held) < 2:
            self.held[number] = text
        for _ in range(units - self.before[number]):
            at = text.index("\n", at + 1)
        return number * self.frame_chars + at + 1

    def stream(self, start: int, end: int) -> Iterator[str]:
        """The characters from ``start`` to ``end``, a frame at a time."""
        while start < end:
            number, skip = divmod(start, self.frame_chars)
            part = self._frame(number)[skip:skip + end - start]
            yield part
            start += len(part)


def write_frames(docs: DataFrame, path: str, frame_chars: int = FRAME_CHARS) -> None:
    """Write ``docs`` (doc_id, text) as frames to ``path``, a row for each text.

    A null or empty text has no frames and no units. A very long text has as
    many frames as it needs. Repeated rows and ids, null ids too, are stored
    each; other columns of ``docs`` are ignored. Empty in, empty out.
    """
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            text = text or ""
            marked = any(marker in text for marker in (PREFIX, SUFFIX, MIDDLE))
            yield (doc_id, unit_count(text), len(text), frame_chars, marked,
                   *pack(text, frame_chars))

    arrow_map(docs.select("doc_id", "text"), rows, STORED, batch_rows=500).write.parquet(path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def texts_of(stored: DataFrame) -> DataFrame:
    """(doc_id, text) of stored frames."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, *directory in rows_of(
                batches, "doc_id", "units", "n_chars", "frame_chars", "before", "frames"):
            yield doc_id, "".join(Frames(*directory).stream(0, directory[1]))

    return arrow_map(stored, rows, "doc_id long, text string", batch_rows=500)


# -- examples -------------------------------------------------------------------

def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the seed and the id; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(stored: DataFrame, seed: int = 7, share: int = 100,
                   suffix_first: int = 50) -> DataFrame:
    """(doc_id, units, form, prefix_chars, middle_chars, output, output_sha256) of stored texts.

    Two of the n + 1 places around the units are drawn; prefix, middle and
    suffix lie before, between and after them, and any may be empty. ``share``
    per cent of the texts are rearranged, and of those ``suffix_first`` per
    cent as spm (suffix, prefix, middle), the others as psm (prefix, suffix,
    middle). An empty text and one that has a marker are plain: the output is
    the text, and the counts of characters are null. The same id draws alike.
    Empty in, empty out; columns other than those stored are ignored.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    one, two = (h % (F.col("units") + 1) for h in (h1, h2))
    plain = (F.col("n_chars") == 0) | F.col("marked") | (h3 % 100 >= share)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    planned = stored.select(
        "doc_id", "units", "n_chars", "frame_chars", "before", "frames", form.alias("form"),
        F.least(one, two).alias("one"), F.greatest(one, two).alias("two"))
    names = ("doc_id", "form", "one", "two", "units", "n_chars", "frame_chars", "before", "frames")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, form, one, two, *directory in rows_of(batches, *names):
            text = Frames(*directory)
            if form == "plain":
                first = second = None
                order = [("", 0, text.n_chars)]
            else:
                first, second = text.end_of(one), text.end_of(two)
                parts = {"p": (PREFIX, 0, first), "s": (SUFFIX, second, text.n_chars),
                         "m": (MIDDLE, first, second)}
                order = [parts[letter] for letter in form]
            output, digest = [], hashlib.sha256()
            for marker, start, end in order:
                for part in (marker, *text.stream(start, end)):
                    output.append(part)
                    digest.update(part.encode())
            middle = None if second is None else second - first
            yield (doc_id, text.units, form, first, middle, "".join(output), digest.hexdigest())

    return arrow_map(planned, rows, EXAMPLES, batch_rows=500)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form came from; a null output stays null.

    The text holds no marker, and no marker can arise where parts meet, so the
    markers are found wherever they stand.
    """
    def part(text: Column, marker: str, nth: int) -> Column:
        return F.split_part(text, F.lit(marker), F.lit(nth))

    head, middle = part(output, MIDDLE, 1), part(output, MIDDLE, 2)
    psm = F.concat(part(part(head, SUFFIX, 1), PREFIX, 2), middle, part(head, SUFFIX, 2))
    spm = F.concat(part(head, PREFIX, 2), middle, part(part(head, PREFIX, 1), SUFFIX, 2))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
