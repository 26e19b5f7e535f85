import json

import pytest
from pyspark.sql import functions as F
from table_rows import rows

from trackmart import schemas
from trackmart.session import scratch_path
from trackmart.sources.commits import Snapshots
from trackmart.streaming import batches, events, live


def play(i, genre="pop", track="T", artist="A", played=1000):
    return (f"{i:05d}", f"{i:05d}", "id", track, artist, genre, 1, 0.1, 0.1, 0.1, 200000, played)


def plays(spark, count=250):
    data = [
        play(i, genre=["pop", "rock", "jazz", "folk", "soul", "rap"][min(i % 7, 5)],
             track=f"T{i % 4}")
        for i in range(count)
    ]
    return spark.createDataFrame(data, schemas.EVENT)


def batched(df, size=100):
    return batches.assign_batches(df, ["event_id"], size)


def test_batches_of_a_fixed_count(spark):
    sizes = batches.batch_sizes(batched(plays(spark)))
    assert rows(sizes, "batch") == [(1, 100), (2, 100), (3, 50)]


def test_no_events(spark):
    empty = batched(plays(spark).limit(0))
    summary = batches.batch_summary(empty)
    assert summary.count() == 0
    assert rows(batches.stream_totals(summary)) == [(0, 0)]


def test_ties_go_to_the_first_seen(spark):
    df = spark.createDataFrame(
        [play(0, "b", "B"), play(1, "a", "A"), play(2, "a", "A"), play(3, "b", "B")], schemas.EVENT
    )
    summary = batches.batch_summary(batched(df)).first()
    assert summary["top_track_1"] == "B — A"
    assert (summary["top_genre_1"], summary["top_genre_2"]) == ("b", "a")


def test_one_genre_leaves_the_second_empty(spark):
    row = batches.batch_summary(batched(spark.createDataFrame([play(0)], schemas.EVENT))).first()
    assert (row["batch_size"], row["top_genre_1_plays"]) == (1, 1)
    assert (row["top_genre_2"], row["top_genre_2_plays"]) == ("", 0)


def test_long_names_are_cut_on_request_only(spark):
    df = spark.createDataFrame([play(0, track="x" * 80)], schemas.EVENT)
    assert batches.batch_summary(batched(df), 50).first()["top_track_1"] == "x" * 50
    assert batches.batch_summary(batched(df)).first()["top_track_1"] == "x" * 80 + " — A"


def test_missing_fields_take_defaults(spark):
    df = spark.createDataFrame([play(0, None, None, None, None), play(1, "pop", played=3000)],
                               schemas.EVENT)
    tracks = {r["track"] for r in batches.track_plays(batched(df)).collect()}
    assert tracks == {"Unknown — Unknown", "T — A"}
    seconds = {r["genre"]: r["avg_seconds"] for r in batches.top_genres(batched(df)).collect()}
    assert seconds == {"unknown": 0.0, "pop": 3.0}


def test_the_sixth_genre_is_missing_from_truncated_totals_only(spark):
    data, i = [], 0
    for _ in range(2):
        for genre, n in [("a", 25), ("b", 20), ("c", 18), ("d", 15), ("e", 12), ("f", 10)]:
            for _ in range(n):
                data.append(play(i, genre))
                i += 1
    df = spark.createDataFrame(data, schemas.EVENT)
    cut = batches.genre_totals_topk(batches.top_genres(batched(df)))
    assert [tuple(r) for r in cut.collect()] == [
        ("a", 50), ("b", 40), ("c", 36), ("d", 30), ("e", 24)
    ]
    assert ("f", 20) in rows(batches.genre_totals(df))


def test_events_from_tracks(spark):
    tracks = spark.createDataFrame(
        [("t1", "Song", "A", None, "x", "0.5", "20000"), ("t2", "Song", "B", "pop", "7.9", "", "")],
        "track_id string, track_name string, artist_name string, genre string, "
        "popularity string, energy string, duration_ms string",
    )
    made = {r["track_id"]: r for r in events.to_events(tracks, "track_id").collect()}
    assert made["t1"]["genre"] == "unknown" and made["t1"]["popularity"] == 0
    assert made["t1"]["play_duration_ms"] == 20000
    assert made["t2"]["popularity"] == 7 and made["t2"]["energy"] == 0.0
    assert made["t2"]["duration_ms"] == 180000
    assert 30000 <= made["t2"]["play_duration_ms"] <= 180000
    again = {r["track_id"]: r for r in events.to_events(tracks, "track_id").collect()}
    assert again["t2"]["event_id"] == made["t2"]["event_id"]
    assert again["t2"]["play_duration_ms"] == made["t2"]["play_duration_ms"]


@pytest.fixture()
def event_folder(spark, tmp_path):
    """Three files of 100, 100 and 50 events, with a blank and a broken line."""
    collected = [r.asDict() for r in plays(spark).orderBy("event_id").collect()]
    for n in range(3):
        lines = [json.dumps(e) for e in collected[n * 100:(n + 1) * 100]] + ["", "bad"]
        (tmp_path / f"part-{n}.json").write_text("\n".join(lines), encoding="utf-8")
    return str(tmp_path)


def test_one_file_per_micro_batch_equals_the_bounded_summary(spark, event_folder):
    out = scratch_path(spark, "summary")
    stream = live.stream_events(spark, event_folder, 1)
    live.start_batch_summary(stream, out, scratch_path(spark, "state")).awaitTermination()
    kept = live.read_summaries(spark, out).drop("timestamp", "batch_number")
    bounded = batches.batch_summary(batched(plays(spark))).drop("batch_number")
    assert sorted(r["batch_size"] for r in kept.collect()) == [50, 100, 100]
    assert rows(kept.select(sorted(kept.columns))) == rows(bounded.select(sorted(kept.columns)))


def test_a_replayed_micro_batch_adds_nothing(spark):
    out = scratch_path(spark, "summary")
    live.write_batch_summary(plays(spark), 0, out)
    live.write_batch_summary(plays(spark), 0, out)
    assert live.read_summaries(spark, out).count() == 1
    live.write_batch_summary(plays(spark), 0, out, "another stream")
    assert live.read_summaries(spark, out).count() == 2


def test_running_totals_equal_the_bounded_totals(spark, event_folder):
    out = scratch_path(spark, "totals")
    stream = live.stream_events(spark, event_folder, 1)
    live.start_genre_totals(stream, out, scratch_path(spark, "state")).awaitTermination()
    assert rows(live.latest_totals(spark, out)) == rows(batches.genre_totals(plays(spark)))


def test_running_totals_of_a_new_run_take_over(spark, event_folder, tmp_path):
    out = scratch_path(spark, "totals")
    stream = live.stream_events(spark, event_folder, 1)
    live.start_genre_totals(stream, out, scratch_path(spark, "state")).awaitTermination()
    other = scratch_path(spark, "other")
    plays(spark).limit(1).withColumn("genre", F.lit("rock")).write.json(other)
    stream = live.stream_events(spark, other, 1)
    live.start_genre_totals(stream, out, scratch_path(spark, "state")).awaitTermination()
    assert rows(live.latest_totals(spark, out)) == [("rock", 1)]
    kept = Snapshots(spark, out).log
    assert len(kept.versions()) <= Snapshots(spark, out).keep
    assert len([n for n in kept.names("") if n.startswith("version-")]) == len(kept.versions())


def test_counted_batches_go_over_micro_batches_and_replays(spark):
    out, made = scratch_path(spark, "counted"), plays(spark)
    order = ["event_id"]
    bounded = batches.batch_summary(batches.assign_batches(made, order, 100))
    first = sorted(r["event_id"] for r in made.select("event_id").collect())
    cuts = [first[:70], first[70:130], first[130:]]
    for number, ids in enumerate(cuts):
        part = made.filter(F.col("event_id").isin(ids))
        live.write_counted_batches(part, number, out, order)
        live.write_counted_batches(part, number, out, order)
    assert rows(live.counted_summary(spark, out)) == rows(bounded)


def test_each_batch_stays_within_one_file(spark):
    folder = scratch_path(spark, "files")
    live.write_event_files(batched(plays(spark, 1000)), folder, 4)
    spread = spark.read.json(folder).withColumn("file", F.input_file_name())
    per_batch = spread.groupBy("batch").agg(F.count_distinct("file").alias("n"))
    assert per_batch.filter("n > 1").count() == 0
