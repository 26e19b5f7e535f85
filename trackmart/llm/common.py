"""Helpers that several operators share."""

from __future__ import annotations

import functools
import os
import pathlib
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.session import written

__all__ = ["WORD", "arrow_map", "documents", "fold_case", "held_out", "map_batches", "rows_of",
           "small_batches", "word_count", "written"]

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same fold for UTF-8 bytes; bytes of other characters are 128 or more.
FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


@functools.cache
def _packed() -> str:
    """This package as a zip file, for the workers."""
    package = pathlib.Path(__file__).resolve().parents[1]
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), "trackmart.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    return path


_served: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, as ``--py-files`` does."""
    context: SparkContext = spark.sparkContext
    if context.applicationId not in _served:
        context.addPyFile(_packed())
        _served.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def fold_case(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 modulo 3. A null id is trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts can be long: hand Python fewer rows at once than Spark's default of 10,000.

    A session with a setting of its own keeps it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples; null stays None."""
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in columns))


def arrow_map(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]],
              schema: str, batch_rows: int = 2000, batch_bytes: int = 8 << 20) -> DataFrame:
    """``mapInArrow`` for a generator of tuples, which go out in bounded batches."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in rows(batches):
            held.append(row)
            size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
            if len(held) >= batch_rows or size >= batch_bytes:
                yield _batch(held, fields)
                held, size = [], 0
        if held:
            yield _batch(held, fields)

    return map_batches(df, run, schema)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(column, field.type) for column, field in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, schema=fields)
