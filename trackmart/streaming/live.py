"""Structured Streaming forms: sources, per-batch sinks, running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from trackmart import schemas
from trackmart.operators.dedup import number_rows
from trackmart.sources.commits import PartTable, Snapshots
from trackmart.sources.lake import from_messages, json_lines
from trackmart.session import written
from trackmart.streaming.batches import (
    batch_counts,
    batch_summary,
    genre_totals,
    merge_counts,
    summarise,
)

# Events whose producer already numbered them.
NUMBERED_EVENT = T.StructType(
    schemas.EVENT.fields + [T.StructField("seq", T.LongType()), T.StructField("batch", T.LongType())]
)


def stream_events(
    spark: SparkSession,
    folder: str,
    files_per_trigger: int = 1,
    schema: T.StructType = schemas.EVENT,
) -> DataFrame:
    """JSON-lines files of a folder as a stream, some files per micro-batch."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    return json_lines(reader, folder, schema)


def stream_topic(
    spark: SparkSession, servers: str, topic: str, trigger_offsets: int = 1_000_000, **options: str
) -> DataFrame:
    """A Kafka topic as a stream of events, at most ``trigger_offsets`` per micro-batch.

    How many events a batch has is a matter of ``start_counted_batches``. Needs
    the Kafka connector of the cluster.
    """
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", trigger_offsets)
        .options(**options)
        .load()
    )
    return from_messages(messages)


def write_event_files(events: DataFrame, folder: str, files: int) -> None:
    """Numbered events as JSON lines, each batch whole within one file."""
    spread = events.repartitionByRange(files, "batch")
    spread.write.mode("overwrite").json(folder)


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_batch_summary(
    events: DataFrame, micro_batch: int, folder: str, stream: str = ""
) -> None:
    """Add the summaries of one micro-batch to the table in ``folder``; a replay changes nothing.

    Events without a ``batch`` are one batch, numbered like the micro-batch from
    1; without ``seq``, ties go to the earlier timestamp and event id.
    """
    if "batch" not in events.columns:
        events = events.withColumn("batch", F.lit(micro_batch + 1).cast("bigint"))
    if "seq" not in events.columns:
        events = events.withColumn("seq", F.struct("timestamp", "event_id"))
    summary = batch_summary(events).withColumn("timestamp", F.current_timestamp())
    PartTable(events.sparkSession, folder).append(summary, micro_batch, stream)


def start_batch_summary(
    events: DataFrame, folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Summarise each micro-batch: what is available and stop, or ``every`` so often.

    The summaries go to a table whose parts are merged, see ``read_summaries``.
    """
    def sink(micro: DataFrame, number: int) -> None:
        write_batch_summary(micro, number, folder, checkpoint)

    return _start(events.writeStream.foreachBatch(sink), checkpoint, every)


def read_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """All batch summaries that were committed."""
    return PartTable(spark, folder).read()


def _counted(spark: SparkSession, folder: str) -> PartTable:
    return PartTable(spark, folder, combine=merge_counts)


def write_counted_batches(
    events: DataFrame, micro_batch: int, folder: str, order: Sequence[str], size: int = 100,
    stream: str = "",
) -> None:
    """Count one micro-batch into batches of ``size`` events, going on where the last one ended.

    Events are numbered in ``order``, then by their place. The counts of its part
    of each batch are committed together with the number of events so far, so
    that a replay changes nothing; counts of one batch are added up as parts
    are merged.
    """
    table = _counted(events.sparkSession, folder)
    if micro_batch <= table.last_batch(stream):
        return
    before = table.notes().get("events", 0)
    numbered = number_rows(written(events, "micro"), order)
    numbered = numbered.withColumn("seq", F.col("seq") + before)
    batch = numbered.withColumn("batch", F.expr(f"(seq - 1) div {int(size)} + 1"))
    counts = written(batch_counts(batch), "counts")
    arrived = counts.filter("kind = 'size'").agg(F.sum("plays")).first()[0] or 0
    table.append(counts, micro_batch, stream, {"events": before + arrived})


def start_counted_batches(
    events: DataFrame, folder: str, checkpoint: str, order: Sequence[str], size: int = 100,
    every: str | None = None,
) -> StreamingQuery:
    """Batches of ``size`` events over a stream of plain events, whatever its micro-batches hold.

    A micro-batch is numbered by all tasks. ``stateful.start_state_batches``
    keeps the batches in the state store instead, by lanes.
    """
    def sink(micro: DataFrame, number: int) -> None:
        write_counted_batches(micro, number, folder, order, size, checkpoint)

    return _start(events.writeStream.foreachBatch(sink), checkpoint, every)


def counted_summary(spark: SparkSession, folder: str, name_width: int | None = None) -> DataFrame:
    """The summary of all batches counted so far; the last one may still grow."""
    return summarise(_counted(spark, folder).read(), name_width)


def start_genre_totals(
    events: DataFrame, folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep exact plays per genre; ``folder`` holds the result after the last micro-batch.

    The state is one count per genre. Each result is a new version, of which a
    few are kept, so a reader has a whole one and the folder does not grow. A
    new run into the folder takes over from the one before.
    """
    def sink(totals: DataFrame, number: int) -> None:
        Snapshots(totals.sparkSession, folder).publish({"totals": totals}, number, checkpoint)

    totals = genre_totals(events).writeStream.outputMode("complete")
    return _start(totals.foreachBatch(sink), checkpoint, every)


def latest_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The running totals after the last micro-batch."""
    return Snapshots(spark, folder).read()["totals"]
