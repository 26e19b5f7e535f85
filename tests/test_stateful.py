"""Batches in the state store of a stream."""

import os

import pytest
from pyspark.sql import functions as F
from table_rows import rows
from test_streaming import plays

from trackmart.session import scratch_path
from trackmart.sources.commits import PartTable
from trackmart.streaming import batches, live, stateful


def add_files(spark, folder, ids, parts):
    """Files of events by id, one after another."""
    made = plays(spark, 400).withColumn("n", F.col("event_id").cast("int"))
    for part in parts:
        some = made.filter(F.col("n").isin(list(ids[part]))).drop("n")
        some.coalesce(1).write.mode("append").json(folder)


@pytest.fixture
def sources(spark):
    return scratch_path(spark, "events"), scratch_path(spark, "counted"), scratch_path(spark, "ckpt")


def run(spark, source, out, checkpoint, **options):
    stream = live.stream_events(spark, source, 1)
    query = stateful.start_state_batches(stream, out, checkpoint, F.col("event_id"), **options)
    query.awaitTermination()


def test_a_restart_goes_on_within_the_open_batch(spark, sources):
    source, out, checkpoint = sources
    ids = [range(0, 70), range(70, 100), range(100, 330), range(330, 331), range(331, 400)]
    add_files(spark, source, ids, [0, 1])
    run(spark, source, out, checkpoint)
    first = batches.batch_summary(batches.assign_batches(
        plays(spark, 400).limit(100), ["event_id"]))
    assert rows(stateful.state_summary(spark, out, checkpoint).drop("lane")) == rows(first)
    assert stateful.open_batches(spark, checkpoint).count() == 0
    for parts in ([2], [3, 4]):  # each a run of its own, from the checkpoint
        add_files(spark, source, ids, parts)
        run(spark, source, out, checkpoint)
    whole = batches.batch_summary(batches.assign_batches(plays(spark, 400), ["event_id"]))
    assert rows(stateful.state_summary(spark, out, checkpoint).drop("lane")) == rows(whole)
    assert [n for n in os.listdir(out) if "micro" in n] == []


def test_the_open_batch_is_read_from_the_state(spark, sources):
    source, out, checkpoint = sources
    add_files(spark, source, [range(0, 250)], [0])
    run(spark, source, out, checkpoint)
    found = rows(stateful.state_summary(spark, out, checkpoint).select("batch_number", "batch_size"))
    assert found == [(1, 100), (2, 100), (3, 50)]
    assert rows(PartTable(spark, out).read().filter("kind = 'size'").select("batch")) == [(1,), (2,)]


def test_lanes_count_apart(spark, sources):
    source, out, checkpoint = sources
    add_files(spark, source, [range(0, 90), range(90, 400)], [0, 1])
    lane = F.col("event_id").cast("int") % 3
    run(spark, source, out, checkpoint, size=50, lane=lane, tasks=2)
    got = stateful.state_summary(spark, out, checkpoint, size=50)
    made = plays(spark, 400)
    for number in range(3):
        own = made.filter(lane == number)
        want = batches.batch_summary(batches.assign_batches(own, ["event_id"], 50))
        assert rows(got.filter(F.col("lane") == number).drop("lane")) == rows(want)


def test_a_micro_batch_is_counted_by_some_batches_at_a_time(spark, sources, monkeypatch):
    monkeypatch.setattr(stateful, "COUNTED", 30)
    source, out, checkpoint = sources
    add_files(spark, source, [range(0, 45), range(45, 400)], [0, 1])
    run(spark, source, out, checkpoint, size=20)
    want = batches.batch_summary(batches.assign_batches(plays(spark, 400), ["event_id"], 20))
    got = stateful.state_summary(spark, out, checkpoint, 20).drop("lane")
    assert rows(got) == rows(want)
