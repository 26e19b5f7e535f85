"""Exact dedup by recipes of content-defined chunks (operator 4).

A text is cut where a rolling hash of its last 32 bytes has a certain value, so
equal texts are cut alike. Every distinct chunk moves through one shuffle,
where chunks of one hash are compared byte by byte: a chunk's identifier is
its hash, plus a number where several contents share it. A document is then
the list of its identifiers, and equal lists mean equal texts. Whole documents
are never moved or compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart.llm.common import FOLD, arrow_map, fold_case, rows_of, small_batches, written

#: A cut where 11 bits of the rolling hash are zero: 2,048 bytes on average after the least size.
CUT_BITS, LEAST, MOST = 11, 512, 16_384
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(data: bytes, bits: int = CUT_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Where the chunks of ``data`` end; the last end is its length, none for no data."""
    if not data:
        return []
    n, ends, last = len(data), [], 0
    if n > least:
        h = _GEAR[np.frombuffer(data, np.uint8)]
        for step in (1, 2, 4, 8, 16):
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        for cut in (np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1).tolist():
            while cut - last > most:
                last += most
                ends.append(last)
            if cut - last >= least:
                ends.append(cut)
                last = cut
        while n - last > most:
            last += most
            ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _chunks(text: str | None) -> Iterator[tuple[bytes, bytes]]:
    """(hash, chunk) in order; the hash has 128 bits."""
    data, last = (text or "").encode().translate(FOLD), 0
    for end in chunk_ends(data):
        chunk = data[last:end]
        yield xxhash.xxh3_128_digest(chunk), chunk
        last = end


def chunk_table(docs: DataFrame) -> DataFrame:
    """(hash, chunk): the distinct chunks of the texts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (text,) in rows_of(batches, "text"):
            yield from _chunks(text)

    return arrow_map(docs.select("text"), rows, "hash binary, chunk binary").distinct()


def clashes(docs: DataFrame) -> DataFrame | None:
    """(hash, chunk, number) of contents that share a hash with another one; None without any.

    Every content of every hash is compared; the table is read again only
    where some differ.
    """
    several = chunk_table(docs).groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    several = written(several.select("hash"), "clashes")
    if several.isEmpty():
        return None
    number = F.row_number().over(Window.partitionBy("hash").orderBy("chunk"))
    return chunk_table(docs).join(several, "hash").withColumn("number", number)


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, recipe, text_sha256): the ordered, verified chunk identifiers of each document.

    A recipe is a list of identifiers of 16 bytes, written one after another;
    an empty or null text has an empty one.
    """
    small_batches(docs.sparkSession)
    clashing = clashes(docs)
    if clashing is not None:
        return _numbered(docs, clashing)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text, digest in rows_of(batches, "doc_id", "text", "sha"):
            yield doc_id, b"".join(h for h, _ in _chunks(text)), digest

    schema = "doc_id long, recipe binary, text_sha256 string"
    return arrow_map(_with_digest(docs), rows, schema)


def _with_digest(docs: DataFrame) -> DataFrame:
    plain = fold_case(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", "text", F.sha2(plain.cast("binary"), 256).alias("sha"))


def _numbered(docs: DataFrame, clashing: DataFrame) -> DataFrame:
    """Recipes where contents share a hash: their number joins the identifier."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text, digest in rows_of(batches, "doc_id", "text", "sha"):
            parts = list(_chunks(text))
            yield doc_id, digest, [h for h, _ in parts], [c for _, c in parts]

    schema = "doc_id long, text_sha256 string, hashes array<binary>, chunks array<binary>"
    listed = arrow_map(_with_digest(docs), rows, schema).withColumn("row", F.expr("uuid()"))
    listed = written(listed, "listed")
    pieces = listed.select("row", F.posexplode(F.arrays_zip("hashes", "chunks")).alias("pos", "c"))
    pieces = pieces.select("row", "pos", "c.hashes", "c.chunks")
    named = clashing.select(F.col("hash").alias("hashes"), F.col("chunk").alias("chunks"), "number")
    numbered = pieces.join(named, ["hashes", "chunks"], "left").select(
        "row", F.struct("pos", F.concat(
            "hashes", F.encode(F.lpad(F.coalesce("number", F.lit(0)).cast("string"), 8, "0"),
                               "UTF-8")).alias("id")).alias("part"))
    ordered = numbered.groupBy("row").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    recipe = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["id"]))
    return listed.join(ordered.select("row", recipe.alias("recipe")), "row", "left").select(
        "doc_id", F.coalesce("recipe", F.lit(b"")).alias("recipe"), "text_sha256")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal that are identical after lower-casing A-Z, whole, however
    long; null equals empty. The row with the largest doc_id of a group stays; a null id stays
    only in a group without another. Of several rows with that id one stays.
    Other columns of ``docs`` are ignored. Empty in, empty out.
    """
    rows = recipes(docs).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "recipes")
    groups = rows.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                                        F.count("*").alias("group_size"))
    return rows.join(groups, "recipe").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    Of rows that agree in doc_id and folded text the first by text and other
    values stays, so that a rerun keeps the same.
    """
    stay = exact_duplicates(docs).filter("kept").select(
        _row_key(F.col("doc_id"), F.col("text_sha256")).alias("key"))
    sha = F.sha2(fold_case(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    held = docs.select(_row_key(F.col("doc_id"), sha).alias("key"), F.struct("*").alias("row"))
    others = [F.col("row").getField(c) for c in docs.columns if c != "text"]
    order = [F.col("row.text"), F.to_json(F.struct(*others))]
    best = held.join(stay, "key", "left_semi").withColumn(
        "nth", F.row_number().over(Window.partitionBy("key").orderBy(*order)))
    return best.filter("nth = 1").select("row.*")


def _row_key(doc_id: Column, sha: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), sha)
