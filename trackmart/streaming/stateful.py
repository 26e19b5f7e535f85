"""Batches of a fixed count kept in the state store of a stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from trackmart.sources.commits import PartTable
from trackmart.streaming.batches import summarise
from trackmart.streaming.events import event_defaults, with_display_key

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KINDS = ("track", "genre")
#: Names of either kind that a closed batch passes on, as its summary needs.
KEPT = 2
#: Events of a micro-batch that are counted at a time, about.
COUNTED = 200_000
COUNTS = "lane int, batch long, kind string, name string, plays long, first_seq long"


def batch_counter(size: int, order_type: T.DataType) -> StatefulProcessor:
    """Counts the events of a lane into batches of ``size``, in the order of values of a type.

    The state of a lane is the number of its events and the counts of its open
    batch: as many names as a batch has events, whatever has arrived. A batch
    that is full leaves the state as the rows of its summary. A micro-batch is
    held as numbers for its names and its order, and counted by some batches at
    a time.
    """
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    import pyarrow.compute as pc

    kinds, kept, at_type = KINDS, KEPT, to_arrow_type(order_type)
    step = size * max(1, COUNTED // size)
    names = [column.split()[0] for column in COUNTS.split(", ")]

    # Defined here, the class travels to the workers by value.
    class BatchCounter(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.events = handle.getValueState("events", "events long")
            self.open = handle.getMapState(
                "open", "kind string, name string", "plays long, first_seq long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                            timer_values) -> Iterator[pd.DataFrame]:
            lane = key[0]
            came = self._in_order(rows)
            before = self.events.get()[0] if self.events.exists() else 0
            after = before + len(came["order"])
            held = [(before // size + 1, *name, *count) for name, count in self.open.iterator()]
            for start in range(before - before % size, after, step):
                first, last = max(start, before), min(start + step, after)
                some = came["order"][first - before:last - before]
                part = pd.DataFrame({
                    kind: came["names"][kind][came["codes"][kind][some]] for kind in kinds})
                part["seq"] = range(first + 1, last + 1)
                part["batch"] = (part["seq"] - 1) // size + 1
                counts = self._counts(part)
                if held:
                    counts = pd.concat([pd.DataFrame(held, columns=counts.columns), counts])
                    counts = counts.groupby(["batch", "kind", "name"], as_index=False).agg(
                        {"plays": "sum", "first_seq": "min"})
                opened = counts["batch"] > last // size
                held = list(counts[opened].itertuples(index=False, name=None))
                order = counts[~opened].sort_values(
                    ["plays", "first_seq"], ascending=[False, True])
                top = order.groupby(["batch", "kind"]).head(kept)
                yield top.assign(lane=lane)[names]
            self.events.update((after,))
            self.open.clear()
            for _, kind, name, plays, first_seq in held:
                self.open.updateValue((kind, name), (plays, first_seq))

        @staticmethod
        def _in_order(rows: Iterator[pd.DataFrame]) -> dict:
            """The events of a micro-batch as codes of their names, with their order: a name is
            kept once, and the values that order them as Arrow columns."""
            books, at = {kind: {} for kind in kinds}, []
            codes = {kind: [] for kind in kinds}
            for chunk in rows:
                at.append(pa.Array.from_pandas(chunk["at"], type=at_type))
                for kind, book in books.items():
                    found, uniques = pd.factorize(chunk[kind], use_na_sentinel=False)
                    numbers = [book.setdefault(None if pd.isna(name) else name, len(book))
                               for name in uniques]
                    codes[kind].append(np.array(numbers, np.int32)[found])
            order = pc.sort_indices(pa.chunked_array(at), null_placement="at_end").to_numpy()
            return {"order": order,
                    "codes": {kind: np.concatenate(parts) for kind, parts in codes.items()},
                    "names": {kind: np.array(list(book), object) for kind, book in books.items()}}

        @staticmethod
        def _counts(came: pd.DataFrame) -> pd.DataFrame:
            parts = []
            for kind in ("size", *kinds):
                name = came[kind] if kind in kinds else ""
                parts.append(pd.DataFrame({"batch": came["batch"], "kind": kind, "name": name,
                                           "first_seq": came["seq"]}))
            rows = pd.concat(parts)
            return rows.groupby(["batch", "kind", "name"], as_index=False).agg(
                plays=("first_seq", "size"), first_seq=("first_seq", "min"))[
                ["batch", "kind", "name", "plays", "first_seq"]]

        def close(self) -> None:
            pass

    return BatchCounter()


def start_state_batches(
    events: DataFrame, folder: str, checkpoint: str, order: Column, size: int = 100,
    lane: Column | None = None, tasks: int = 1, every: str | None = None,
) -> StreamingQuery:
    """Batches of ``size`` events over a stream of plain events, counted in its state store.

    The events of a lane are put in ``order`` within a micro-batch and follow
    those of the micro-batches before. One lane, the default, is one sequence
    over all events and passes through one task, a micro-batch at a time, with
    three columns; a ``lane`` number, such as the partition of a topic or a
    hash of the track, counts batches of its own in each and spreads them over
    ``tasks``, for good: a checkpoint keeps their number. Closed batches go to a table of merged parts in ``folder``; a restart
    from the checkpoint goes on within the open batch.
    """
    spark = events.sparkSession
    named = with_display_key(event_defaults(events))
    keyed = named.select(
        (F.lit(0) if lane is None else lane).cast("int").alias("lane"),
        order.alias("at"), "track", "genre")
    counts = keyed.groupBy("lane").transformWithStateInPandas(
        batch_counter(size, keyed.schema["at"].dataType), COUNTS, outputMode="Append", timeMode="None")

    def sink(closed: DataFrame, number: int) -> None:
        PartTable(closed.sparkSession, folder).append(closed, number, checkpoint)

    writer = counts.writeStream.outputMode("append").foreachBatch(sink)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    settings = {PROVIDER: ROCKSDB, "spark.sql.shuffle.partitions": str(tasks)}
    before = {name: spark.conf.get(name) for name in settings}
    try:  # the query keeps the settings it starts with
        for name, value in settings.items():
            spark.conf.set(name, value)
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def open_batches(spark: SparkSession, checkpoint: str, size: int = 100) -> DataFrame:
    """(lane, batch, kind, name, plays, first_seq): the counts of the open batches, as the state
    store has them after the last micro-batch."""
    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    came = state("events").select("key.lane", F.col("value.events").alias("events"))
    held = state("open").select(
        "key.lane", "user_map_key.kind", "user_map_key.name", "user_map_value.plays",
        "user_map_value.first_seq")
    joined = held.join(came, "lane")
    return joined.withColumn("batch", F.expr(f"events div {int(size)} + 1")).select(
        "lane", "batch", "kind", "name", "plays", "first_seq")


def state_summary(spark: SparkSession, folder: str, checkpoint: str, size: int = 100,
                  name_width: int | None = None) -> DataFrame:
    """The summaries of all batches, with their lane: the closed ones, and the open ones as they
    stand. To be read while the query is not running."""
    closed = PartTable(spark, folder).read()
    counts = closed.unionByName(open_batches(spark, checkpoint, size))
    lanes = counts.withColumn("batch", F.struct("lane", "batch"))
    rows = summarise(lanes, name_width)
    return rows.select(F.col("batch_number.lane").alias("lane"),
                       F.col("batch_number.batch").alias("batch_number"),
                       *[c for c in rows.columns if c != "batch_number"])
