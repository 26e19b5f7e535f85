"""Counts of the steps of a stream, places in files, and sketches of frequent items."""

import json
import random

import pytest
from pyspark.sql import functions as F
from table_rows import rows
from test_streaming import plays

from trackmart.operators import dedup, frequent
from trackmart.session import scratch_path
from trackmart.sources import lake
from trackmart.streaming import live, metrics


def test_lines_in_dropped_and_counted_of_each_run(spark, tmp_path):
    collected = [r.asDict() for r in plays(spark).orderBy("event_id").collect()]
    listener = metrics.StepListener()
    spark.streams.addListener(listener)
    checkpoint, out = scratch_path(spark, "state"), scratch_path(spark, "totals")
    found = []
    try:
        for n in range(3):  # the last run finds nothing new
            if n < 2:
                for part in range(3):
                    some = collected[n * 90 + part * 30:n * 90 + part * 30 + 30]
                    lines = [json.dumps(e) for e in some] + ["", "bad", "[1]", "{}"]
                    (tmp_path / f"{n}-{part}.json").write_text("\n".join(lines), encoding="utf-8")
            stream = metrics.watched_events(spark, str(tmp_path), 1)
            query = live.start_genre_totals(stream, out, checkpoint)
            query.awaitTermination()
            found.append(listener.counts(query))
    finally:
        spark.streams.removeListener(listener)
    for counts in found[:2]:
        assert rows(metrics.stream_steps(spark, counts)) == [("read_events", 99, 93, 6)]
        assert counts["events"]["without_genre"] == 3
    assert rows(metrics.stream_steps(spark, found[2])) == [("read_events", 0, 0, 0)]


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_places_follow_the_files(spark, kind):
    path = scratch_path(spark, "files")
    made = spark.range(1000).select(F.col("id").alias("n"), (F.col("id") % 7).alias("k"))
    made.repartitionByRange(5, "n").sortWithinPartitions("n").write.format(kind).save(path)
    scan = spark.read.schema("n bigint, k bigint").format(kind).load(path)
    placed = lake.with_file_order(scan).repartition(3, "k")
    assert rows(dedup.head_rows(placed, 300, ["file_order"]).select("n"), "n") == [
        (i,) for i in range(300)]
    first = dedup.dedup_any(placed, ["k"], ["file_order"])
    assert rows(first.select("k", "n"), "k") == [(i, i) for i in range(7)]


@pytest.mark.parametrize("k", [1, 4, 50])
def test_bounds_hold_in_whatever_order_sketches_are_merged(spark, k):
    draw = random.Random(k)
    parts = [[f"n{min(int(draw.paretovariate(0.8)), 40)}" for _ in range(300)] for _ in range(6)]
    exact = {}
    for name in sum(parts, []):
        exact[name] = exact.get(name, 0) + 1
    sketches = []
    for part in parts:
        df = spark.createDataFrame([(name,) for name in part] + [(None,)], "name string")
        counts = df.groupBy("name").agg(F.count(F.lit(1)).alias("plays"))
        sketches.append(frequent.sketch_of(counts, k))
    left = sketches[0]
    for other in sketches[1:]:
        left = frequent.merge_sketches(left.unionByName(other), k)
    together = sketches[5]
    for other in sketches[:5]:
        together = together.unionByName(other)
    for sketch in (left, frequent.merge_sketches(together, k)):
        found = {r["name"]: (r["lower"], r["upper"]) for r in frequent.bounds(sketch).collect()}
        error = sketch.filter("name is null").first()["error"]
        assert len(found) <= k and error <= 1800 / (k + 1)
        assert all(found[n][0] <= exact[n] <= found[n][1] for n in found)
        assert all(n in found or count <= error for n, count in exact.items())
    if k == 50:
        assert {n: low for n, (low, _) in found.items()} == exact


def test_no_rows_give_an_empty_sketch(spark):
    counts = spark.createDataFrame([], "name string, plays long")
    assert rows(frequent.sketch_of(counts, 3)) == [(None, 0, 0)]
    assert rows(frequent.bounds(frequent.sketch_of(counts, 3))) == []
