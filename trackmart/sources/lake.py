"""Layer paths, scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from trackmart import schemas
from trackmart.functions.columns import WHOLE_TYPES, lenient_cast, whole_number
from trackmart.sources.records import LINE, QUOTING, read_lines, read_records


@dataclass(frozen=True)
class LakePaths:
    """Raw, processed and curated locations under any Hadoop URI."""

    root: str

    def _layer(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def raw(self, name: str) -> str:
        return self._layer("raw", name)

    def processed(self, name: str) -> str:
        return self._layer("processed", name)

    def curated(self, name: str) -> str:
        return self._layer("curated", name)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    skip_long_lines: bool = False,
    multi_line: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV, usually with a header, with every column as text and blanks as NULL.

    The header names the columns, whatever their order; ``columns`` are those
    wanted, and name the fields of a file without a header. ``skip_long_lines``
    drops lines with more fields than the header or ``columns`` have, blank ones
    counted; a line with fewer keeps NULL in the rest. A file splits over many
    tasks, one line being one row; ``multi_line`` keeps a line break inside
    quotes in its field, see ``records``: files split all the same, each is
    looked through once more, and a stray quote costs its own record.
    """
    if header:
        names = spark.read.options(**QUOTING, header=True).csv(path).columns
        absent = [c for c in columns or () if c not in names]
        if absent:
            raise ValueError(f"the header of {path} lacks {absent}")
    elif columns is None:
        raise ValueError("a file without a header needs the names of its columns")
    else:
        names = list(columns)
    read = read_records if multi_line else read_lines
    rows = read(spark, path, names, header, skip_long_lines)
    return rows if columns is None else rows.select(*[F.col(f"`{c}`") for c in columns])


def with_file_order(scan: DataFrame, name: str = "file_order") -> DataFrame:
    """A scan of files with the place of every row: its file, split and row.

    Files count in the order of their names, as a writer numbers its parts; so
    ``head_rows`` and ``dedup_any`` by this column take what is first in the
    files. ``scan`` has to be fresh from the reader. Parquet knows the number
    of a row; in other formats rows are numbered as a split is read.
    """
    known = scan.select("_metadata").schema["_metadata"].dataType.names
    numbered = "row_index" in known
    row = F.col("_metadata.row_index") if numbered else F.monotonically_increasing_id()
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), row.alias("row"))
    return scan.withColumn(name, place)


def broken_quotes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(broken_lines): how many lines do not close a quote, as fields with line breaks do not."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(path).agg(F.count_if(quotes % 2 == 1).alias("broken_lines"))


def refuse_broken_quotes(spark: SparkSession, path: str | Sequence[str]) -> None:
    """Stop where a file cannot be read line by line."""
    broken = broken_quotes(spark, path).first()["broken_lines"]
    if broken:
        raise ValueError(f"{broken} lines of {path} do not close a quote: read it with multi_line")


def typed_as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, leniently cast from text; 1234.0 is a whole number."""
    def typed(field: T.StructField) -> Column:
        target = field.dataType.simpleString()
        cast = whole_number if target in WHOLE_TYPES else lenient_cast
        return cast(F.col(field.name), target).alias(field.name)

    return df.select(*map(typed, schema.fields))


def json_lines(
    reader: DataFrameReader | DataStreamReader, path: str, schema: T.StructType = schemas.EVENT
) -> DataFrame:
    """JSON lines; blank and unreadable ones are dropped.

    The fields are read as text and cast afterwards, so a field of the wrong type
    is NULL and its line stays, whichever columns a query asks for.
    """
    text = reader.schema(schemas.text_schema(schema.names)).option("mode", "DROPMALFORMED")
    return typed_as(text.json(path), schema)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark.read, path)


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a dataset of a layer."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, path: str, table: str, key: str) -> DataFrame:
    """Replace a dataset of a layer, kept as a table bucketed by ``key``.

    Two datasets bucketed alike join on the key, and aggregate by it, without
    moving a row. The buckets are as many as the shuffle partitions, so rows
    that were just shuffled by the key fall into one file per bucket.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def export_csv(df: DataFrame, path: str) -> None:
    """Headered CSV of a result, its order kept across the part files."""
    writer = df.write.mode("overwrite").options(**QUOTING, header=True)
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def publish(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace a published table: Parquet with a view where a path is given,
    otherwise a table of the session catalog."""
    spark = df.sparkSession
    if path is None:
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
        return spark.table(table)
    df.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.createOrReplaceTempView(table)
    return stored


def to_messages(events: DataFrame) -> DataFrame:
    """Keyed JSON messages, ready for ``write.format("kafka")``."""
    return events.select(
        F.col("track_id").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def send_messages(events: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Events to a Kafka topic; needs the Kafka connector of the cluster."""
    writer = to_messages(events).write.format("kafka").options(**options)
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def from_messages(messages: DataFrame) -> DataFrame:
    """Events from message values; a value that is not a JSON object is dropped.

    An object without any known field is an event of NULLs, as in a file.
    """
    fields = schemas.text_schema([*schemas.EVENT.names, LINE])
    event = F.from_json(
        F.trim(F.col("value").cast("string")), fields, {"columnNameOfCorruptRecord": LINE})
    # As a generated row each value is parsed once, whatever reads its fields.
    read = F.filter(F.array(event), lambda e: e.isNotNull() & e[LINE].isNull())
    has_text = F.trim(F.col("value").cast("string")) != ""
    return typed_as(messages.filter(has_text).select(F.inline(read)), schemas.EVENT)


def write_events(events: DataFrame, path: str) -> None:
    """Events as JSON lines, one file set per run."""
    events.write.mode("overwrite").option("ignoreNullFields", False).json(path)
