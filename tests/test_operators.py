import math
import random
import re

import pytest
from pyspark.sql import functions as F
from table_rows import rows

from trackmart.operators import aggregates, dedup, filters, joins, quality


# Filters

def test_ranges_include_bounds_and_reject_null_and_nan(spark):
    df = spark.createDataFrame(
        [(0.0,), (1.0,), (-0.1,), (1.1,), (None,), (float("nan"),)], "x double"
    )
    assert rows(filters.in_range(df, "x", 0.0, 1.0)) == [(0.0,), (1.0,)]
    assert rows(filters.in_range_or_null(df, "x", 0.0, 1.0)) == [(0.0,), (1.0,), (None,)]


def test_lower_bound(spark):
    df = spark.createDataFrame([(29999,), (30000,), (None,)], "d long")
    assert rows(filters.at_least(df, "d", 30000)) == [(30000,)]


def test_not_equal_drops_null(spark):
    df = spark.createDataFrame([("Independent",), ("A",), (None,)], "label string")
    assert rows(filters.differs(df, "label", "Independent")) == [("A",)]


def test_require_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "x double, y string")
    assert rows(filters.require(df, ["x", "y"])) == [(1.0, "a")]


def test_require_text(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, "b"), ("a", "")], "x string, y string")
    assert rows(filters.require_text(df, ["x", "y"])) == [("a", "b")]


# Dedup and top-k

def test_dedup_best_prefers_highest_then_other_columns(spark):
    df = spark.createDataFrame(
        [("k", 5, "a"), ("k", 5, "b"), ("k", None, "z"), ("n", None, "x"), ("k", 1, "c")],
        "key string, popularity int, name string",
    )
    best = dedup.dedup_best(df, ["key"], ["popularity"])
    assert best.columns == df.columns
    assert rows(best) == [("k", 5, "b"), ("n", None, "x")]


def test_dedup_any_is_the_same_for_any_partitioning(spark):
    data = [(i % 7, str(i % 11), i % 3) for i in range(200)]
    df = spark.createDataFrame(data, "k int, a string, b int")
    once = rows(dedup.dedup_any(df.repartition(3), ["k"]))
    assert once == rows(dedup.dedup_any(df.repartition(4, "b"), ["k"]))
    assert len(once) == 7


def test_dedup_any_takes_the_first_by_order(spark):
    df = spark.createDataFrame([("k", 2, "a"), ("k", 1, "b")], "k string, o int, v string")
    assert rows(dedup.dedup_any(df, ["k"], ["o"])) == [("k", 1, "b")]


def test_top_k_per(spark):
    df = spark.createDataFrame(
        [("a", 3, 1), ("a", 3, 0), ("a", 1, 2), ("b", 1, 5)], "p string, n int, s int"
    )
    top = dedup.top_k_per(df, ["p"], 2, [F.desc("n"), F.asc("s")])
    assert rows(top) == [("a", 3, 0, 1), ("a", 3, 1, 2), ("b", 1, 5, 1)]


def test_head_rows_counts_before_later_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, "c"), (4, "d")], "i int, n string")
    head = dedup.head_rows(df, 3, ["i"])
    assert rows(filters.require_text(head, ["n"])) == [(1, "a"), (3, "c")]


def test_numbers_follow_the_order_over_all_partitions(spark):
    df = spark.range(1000).withColumn("x", F.lit(999) - F.col("id")).repartition(5, "id")
    numbered = rows(dedup.number_rows(df, ["x"]), "seq")
    assert [r[2] for r in numbered] == list(range(1, 1001))
    assert [r[1] for r in numbered] == list(range(1000))


def test_copies_of_one_row_spread_and_keep_their_count(spark, tmp_path):
    path = str(tmp_path / "copies")
    spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("x")
    ).write.parquet(path)
    numbered = dedup.number_rows(spark.read.parquet(path), ["x"])
    got = numbered.agg(F.count("seq"), F.count_distinct("seq"), F.max("seq")).first()
    assert tuple(got) == (900, 900, 900)


def test_numbering_nothing(spark):
    assert dedup.number_rows(spark.range(0), ["id"]).count() == 0


# Joins

ARTISTS = "artist_name string, artist_id string, artist_popularity int, followers long, " \
          "genre_0 string, genre_1 string, genre_2 string"


def artists(spark):
    return spark.createDataFrame([
        ("ABBA", "1", 50, 10, "pop", None, None),
        ("Abba", "2", 60, 10, "pop", None, None),
        ("abba ", "3", None, 10, "pop", None, None),
        ("Other", "4", 1, 1, None, None, None),
        (None, "5", 1, 1, None, None, None),
    ], ARTISTS)


def tracks(spark):
    return spark.createDataFrame([
        ("t1", "Song", "abba"), ("t2", "Song", "Nobody"), ("t3", "x", None),
    ], "track_id string, track_name string, artist_name string")


def test_spellings_are_one_artist_or_repeat_the_track(spark):
    one = joins.enrich_artists(tracks(spark), artists(spark))
    assert rows(one.select("track_id", "artist_id")) == [
        ("t1", "2"), ("t2", None), ("t3", None)
    ]
    many = joins.enrich_artists(tracks(spark), artists(spark), unique_keys=False)
    assert many.count() == 5


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3)], "k string, v int")
    hot = joins.hot_key_hashes(left, {"k": ["k"]}, share=0.1)["k"]
    assert left.filter(joins.key_hash(["k"]).isin(hot)).count() >= 1000
    plain = joins.left_join(left, right, ["k"])
    salted = joins.left_join(left, right, ["k"], hot, ["id"], salts=8)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


@pytest.mark.parametrize("share", [None, 0.1])
def test_repeating_join_equals_plain_join(spark, monkeypatch, share):
    monkeypatch.setattr(joins, "GATHERED", 3)
    left = spark.createDataFrame(
        [(str(i), k) for i, k in enumerate(["a"] * 20 + ["b", "c", None])], "track_id string, k string")
    right = spark.createDataFrame(
        [("a", v, None) for v in [1, 1, 1, 1, 2, 3, None, None]]
        + [("b", 7, "x"), (None, 8, "y"), ("d", 9, "z")], "k string, v int, w string")
    hot = joins.hot_key_hashes(left, {"k": ["k"]}, share)["k"] if share else []
    plain = joins.left_join(left, right, ["k"])
    arrays = joins.gathered(right.filter("k = 'a'"), ["k"], "found").select(F.size("found"))
    assert rows(arrays) == [(2,), (3,), (3,)]
    gathered = joins.repeating_join(left, right, ["k"], hot)
    assert gathered.columns == plain.columns and gathered.dtypes == plain.dtypes
    assert rows(gathered) == rows(plain) and plain.count() == 163
    filled = joins.repeating_join(left, right, ["k"], hot, {"v": 5})
    missed = F.col("k").isNull() | (F.col("k") == "c")
    assert rows(filled) == rows(plain.withColumn("v", F.when(missed, 5).otherwise(F.col("v"))))


def test_best_album_per_track(spark):
    albums = spark.createDataFrame(
        [("t1", "a", 1), ("t1", "b", 9), ("t1", "c", None), (None, "d", 1)],
        "track_id string, album_id string, album_popularity int",
    )
    got = joins.enrich_albums(tracks(spark), albums)
    assert rows(got.select("track_id", "album_id")) == [("t1", "b"), ("t2", None), ("t3", None)]


def test_charts_match_both_names(spark):
    charts = spark.createDataFrame(
        [(" SONG ", "Abba", 5, 1), ("song", "ABBA", 9, 1), ("Song", "Else", 1, 1)],
        "track_name string, artist_name string, streams long, is_chart_hit int",
    )
    one = joins.enrich_charts(tracks(spark), charts)
    assert rows(one.select("track_id", "streams")) == [("t1", 9), ("t2", None), ("t3", None)]
    many = joins.enrich_charts(tracks(spark), charts, unique_keys=False)
    assert rows(many.select("track_id", "streams")) == [
        ("t1", 5), ("t1", 9), ("t2", None), ("t3", None)
    ]


def test_chart_entries_repeat_a_track_after_the_join(spark):
    charts = spark.createDataFrame(
        [("Song", "Abba", i, 1) for i in range(9)],
        "track_name string, artist_name string, streams long, is_chart_hit int")
    many = joins.enrich_charts(tracks(spark), charts, unique_keys=False)
    assert many.count() == 11
    before_join = many._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[0]
    assert "Generate inline" in before_join


# Aggregates

def master(spark, data):
    columns = ["genre", "year", "label", "artist_name", "is_chart_hit", "popularity",
               "album_popularity", "artist_popularity", "followers", "followers_log", "streams",
               "duration_ms"]
    numbers = ["danceability", "energy", "valence", "acousticness", "speechiness", "tempo",
               "loudness", "instrumentalness", "liveness"]
    df = spark.createDataFrame(
        [d + (0, 0, 1, 0.0, 2, 100) for d in data],
        "genre string, year int, label string, artist_name string, is_chart_hit int, "
        "popularity int, album_popularity int, artist_popularity int, followers long, "
        "followers_log double, streams long, duration_ms long",
    )
    assert df.columns == columns
    return df.withColumns({n: F.lit(0.5) for n in numbers})


DATA = [
    ("pop", 2008, "Independent", "A", 0, 10),
    ("pop", 2009, "L1", "A", 1, 11),
    ("rock", 2024, "L2", "B", 0, 40),
    (None, 2025, None, "C", 0, None),
    ("rock", 2010, "L3", "D", 1, 41),
]


def test_genre_counts_and_half_up_rounding(spark):
    got = aggregates.agg_genre(master(spark, DATA)).select(
        "genre", "track_count", "avg_popularity", "chart_hits"
    )
    assert [tuple(r) for r in got.collect()] == [
        ("pop", 2, 10.5, 1), ("rock", 2, 40.5, 1), (None, 1, None, 0)
    ]
    halves = spark.createDataFrame([(25.125,), (0.125,)], "x double")
    assert [r[0] for r in halves.select(F.round("x", 2)).collect()] == [25.13, 0.13]


def test_year_bounds(spark):
    got = aggregates.agg_year(master(spark, DATA))
    assert [r["year"] for r in got.collect()] == [2009, 2010, 2024]


def test_labels_leave_out_independent_and_missing(spark):
    got = aggregates.agg_label(master(spark, DATA), k=2)
    assert [(r["label"], r["total_streams"]) for r in got.collect()] == [("L3", 2), ("L2", 2)]


def test_ties_on_the_rounded_key_go_by_name(spark):
    data = [("g", 2010, f"L{i}", f"N{i}", 0, 10) for i in range(9)]
    labels = aggregates.agg_label(master(spark, data), k=3)
    assert [r["label"] for r in labels.collect()] == ["L0", "L1", "L2"]
    artists_ = aggregates.agg_artist(master(spark, data), k=20)
    assert [r["artist_name"] for r in artists_.collect()] == [f"N{i}" for i in range(9)]


def test_hit_comparison_and_groups_sum_to_the_table(spark):
    got = aggregates.agg_hit(master(spark, DATA)).collect()
    assert [r["is_chart_hit"] for r in got] == [0, 1]
    assert sum(r["track_count"] for r in got) == len(DATA)
    assert len(got[0]) == 15


def test_model_rows_need_the_target(spark):
    assert aggregates.master_ml(master(spark, DATA)).count() == 4


# Quality

def test_observed_counts_come_with_the_write(spark, tmp_path):
    df, seen = quality.observed(
        spark.range(10), "ten", {"even": F.col("id") % 2 == 0}
    )
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"rows": 10, "even": 5}


@pytest.mark.parametrize("joined, fine", [(105, True), (106, False), (100, True)])
def test_fanout_guard(spark, joined, fine):
    assert quality.check_fanout(100, joined) is fine
    row = quality.fanout_report(spark.range(100), spark.range(joined)).first()
    assert row["within_limit"] is fine


def test_missing_table_is_reported(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert rows(quality.table_counts(spark, ["three", "absent"])) == [
        ("absent", None, "ERROR"), ("three", 3, "OK")
    ]


def test_key_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    assert rows(quality.check_keys(df, ["k"])) == [(1, 2, 2)]
    assert rows(quality.check_keys(df.limit(0), ["k"])) == [(0, 0, 0)]


def test_stack_aligns_by_name(spark):
    a = spark.createDataFrame([("RMSE", 1.0)], "metric string, value double")
    b = spark.createDataFrame([(2.0, "MAE")], "value double, metric string")
    got = quality.stack_tagged({"A": a, "B": b, "C": None})
    assert rows(got) == [("MAE", 2.0, "B"), ("RMSE", 1.0, "A")]


def test_hot_rows_spread_over_tasks_when_nothing_is_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], "-1")
        spark.conf.set(names[1], "false")
        left = spark.range(9000).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            "id",
        )
        right = left.select("k").distinct().withColumn("v", F.length("k"))
        hot = joins.hot_key_hashes(left, {"k": ["k"]}, share=0.1)["k"]

        def largest_share(joined):
            # Reading v keeps the join in the plan.
            parts = joined.groupBy(F.spark_partition_id().alias("p")).agg(
                F.count("id").alias("n"), F.max("v").alias("v")
            )
            return parts.agg(F.max("n") / F.sum("n"), F.max("v")).first()[0]

        plain = joins.left_join(left, right, ["k"])
        salted = joins.left_join(left, right, ["k"], hot, ["id"])
        assert largest_share(plain) > 0.4
        assert largest_share(salted) < 0.35
        assert rows(plain) == rows(salted)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_means_do_not_depend_on_the_order_of_the_rows(spark):
    """Sums of doubles would round here and there by the order; means lie on half-way points."""
    draw = random.Random(5)
    data = [(g, draw.choice([0.1, 0.2, 0.3, 1e9 + 0.005, -1e9, 1e-7]), 1) for g in "ab" * 3000]
    data += [("c", v, 1) for v in (0.125, 0.126, 0.124, 0.125)]
    data += [("d", None, 1), ("e", float("nan"), 0), ("e", 1.0, 0), ("f", float("inf"), 1)]
    df = spark.createDataFrame(data, "g string, v double, is_chart_hit int")
    found = []
    for parts in (1, 7, 64):
        for seed in (1, 2):
            mixed = df.repartition(parts, F.xxhash64("v", F.rand(seed)))
            found.append(rows(mixed.groupBy("g").agg(
                *(aggregates.rounded_mean("v", n).alias(f"m{n}") for n in (2, 11))), "g"))
    assert all(repr(f) == repr(found[0]) for f in found)
    means = {g: m for g, m, _ in found[0]}
    assert means["c"] == 0.13 and means["d"] is None
    assert math.isnan(means["e"]) and means["f"] == math.inf


def test_means_of_known_kinds_are_those_of_decimals(spark):
    """Whole numbers are added in place of decimals: half-way points, large, lost and no values."""
    draw = random.Random(7)
    values = {"a": [0.04, 1e-7, 3 / 8192, -3 / 8192, 2.5], "b": [-199.99, 249.5, 0.0, None],
              "c": [5000.25, 1e15, -4097.5, 0.1], "d": [float("nan"), 1.0], "e": [1e20, 1.0],
              "f": [None]}
    data = [(g, draw.choice(of), None if g == "f" else draw.choice([-7, 0, 1, 2**31 - 1, None]),
             None if g == "f" else draw.choice([10**15, -3, 8, 10**16 if g == "e" else 9, None]))
            for g, of in values.items() for _ in range(400)]
    df = spark.createDataFrame(data, "g string, float float, int int, bigint bigint")
    for places in (0, 2, 3):
        found = df.groupBy("g").agg(*(
            F.struct(aggregates.rounded_mean(kind, places), aggregates.rounded_mean(kind, places, kind))
            .alias(kind) for kind in ("float", "int", "bigint")))
        for row in found.collect():
            for plain, cheap in row[1:]:
                assert repr(plain) == repr(cheap), (row["g"], places)


def test_reports_are_the_same_for_any_partitioning(spark):
    draw = random.Random(6)
    places = {c: draw.choice([1, 50]) for c in aggregates.HIT_MEANS}
    columns = [*places, "genre", "year", "label", "album_popularity", "artist_name", "followers",
               "streams", "is_chart_hit"]
    data = [[*(draw.random() * p for p in places.values()), f"g{i % 3}", 2010 + i % 5, f"l{i % 4}",
             draw.random(), f"a{i % 9}", i, i, i % 2] for i in range(4000)]
    master = spark.createDataFrame(data, columns)
    reports = [aggregates.agg_genre, aggregates.agg_year, aggregates.agg_label,
               aggregates.agg_hit, aggregates.agg_artist]
    found = [[rows(report(master.repartition(n))) for report in reports] for n in (1, 7, 64)]
    assert found[0] == found[1] == found[2]


def test_dedup_any_packs_text_in_the_order_of_its_columns(spark):
    data = [("k", "x\0y", "a"), ("k", "x", "z"), ("k", None, "a"), ("n", None, "b"),
            ("n", None, None), ("e", "", "\0\0"), ("e", "", "\0\1"), (None, "0", "1")]
    df = spark.createDataFrame(data, "k string, a string, b string")
    kept = dedup.dedup_any(df, ["k"])
    assert set(map(tuple, kept.collect())) == {
        ("k", "x", "z"), ("n", None, "b"), ("e", "", "\0\0"), (None, "0", "1")}
    # One text per row is sorted and moved, not every column.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit \[k#\d+\], \[_row#", plan)


def test_dedup_any_unpacks_a_row_once_whatever_filters_follow(spark):
    wide = spark.createDataFrame([("k", "7", None, "x\0y")], "k string, a string, b string, c string")
    kept = dedup.dedup_any(wide, ["k"])
    kept = kept.filter("cast(a as int) between 0 and 9 and b is null and length(c) = 3")
    assert rows(kept) == [("k", "7", None, "x\0y")]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
