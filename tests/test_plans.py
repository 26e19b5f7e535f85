import contextlib
import io

import pytest
from pyspark.sql import functions as F
from table_rows import rows

from trackmart import schemas
from trackmart.ml import popularity as P
from trackmart.operators import joins
from trackmart.plans import cleaning, flow, star
from trackmart.plans.master import build_master
from trackmart.session import scratch_path
from trackmart.sources import manifest
from trackmart.sources.lake import LakePaths, read_csv

GOOD = dict(
    artist_name=" Abba ", track_name=" Song ", track_id="t1", popularity="50", year="2010",
    genre=" POP ", danceability="0.5", energy="0.5", key="1", loudness="-5", mode="1",
    speechiness="0.1", acousticness="0.1", instrumentalness="0", liveness="0.1", valence="0.9",
    tempo="120", duration_ms="200000", time_signature="4",
)


def raw_tracks(spark, *changes):
    data = [tuple({**GOOD, **c}[n] for n in schemas.RAW_TRACKS) for c in changes]
    return spark.createDataFrame(data, schemas.text_schema(schemas.RAW_TRACKS))


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_tracks_are_typed_and_tidy(spark):
    got = cleaning.clean_tracks(raw_tracks(spark, {}).withColumn("_c0", F.lit("0")))
    assert got.columns == schemas.RAW_TRACKS
    row = got.first()
    assert (row.artist_name, row.track_name, row.genre) == ("Abba", "Song", "pop")
    assert dict(got.dtypes)["duration_ms"] == "bigint" and dict(got.dtypes)["energy"] == "float"


@pytest.mark.parametrize("change, kept", [
    ({"popularity": "0"}, True), ({"popularity": "100"}, True), ({"popularity": "101"}, False),
    ({"popularity": "-1"}, False), ({"popularity": "x"}, False), ({"popularity": None}, False),
    ({"year": "1900"}, True), ({"year": "2025"}, True), ({"year": "1899"}, False),
    ({"duration_ms": "30000"}, True), ({"duration_ms": "29999"}, False),
    ({"energy": "1.0"}, True), ({"energy": "1.01"}, False), ({"valence": "NaN"}, False),
    ({"liveness": None}, False), ({"genre": None}, False), ({"tempo": None}, True),
])
def test_track_ranges(spark, change, kept):
    assert cleaning.clean_tracks(raw_tracks(spark, change)).count() == int(kept)


def test_an_invalid_survivor_takes_its_track_with_it(spark):
    got = cleaning.clean_tracks(raw_tracks(
        spark, {"artist_name": "A", "popularity": "999"}, {"artist_name": "B"}
    ))
    assert got.count() == 0


def test_charts(spark):
    raw = spark.createDataFrame([
        (" S ", "A ", "12", "99", "80", "1,021"), ("S", "A", "BPM", "x", "abc", "3"),
        ("S", None, "1", "1", "1", "1"), ("S", "A", None, "1", "1", "1"),
    ], "track_name string, `artist(s)_name` string, streams string, bpm string, "
       "`danceability_%` string, in_spotify_charts string")
    got = cleaning.clean_charts(raw)
    assert rows(got.select("track_name", "artist_name", "streams", "tempo", "danceability",
                           "in_spotify_charts", "is_chart_hit")) == [
        ("S", "A", 12, 99.0, 0.8, None, 1), ("S", "A", None, None, None, 3, 1)
    ]


def test_artists(spark):
    raw = spark.createDataFrame([
        ("1", " A ", "100", "5"), ("1", " A ", "100", "5"), ("2", "B", None, None),
        ("3", "C", "101", "5"), ("4", None, "1", "1"), ("5", "E", "x", "y"),
    ], "id string, name string, artist_popularity string, followers string")
    assert rows(cleaning.clean_artists(raw)) == [
        ("1", "A", 100, 5), ("2", "B", 0, 0), ("5", "E", 0, 0)
    ]


def test_albums(spark):
    columns = ["track_id", "track_name", "album_type", "release_date", "label", "total_tracks",
               "extra"]
    raw = spark.createDataFrame([
        ("t1", " N ", " ALBUM ", "2015-06-09 00:00:00 UTC", " L ", "9", "e"),
        ("t2", "N", None, "2015-06", None, None, "e"), ("t3", None, "a", None, "L", "1", "e"),
    ], schemas.text_schema(columns))
    raw = raw.withColumns({c: F.lit("1") for c in ["album_popularity", "duration_ms", "album_name"]})
    got = cleaning.clean_albums(raw)
    assert "extra" not in got.columns
    assert rows(got.select("track_id", "album_type", "label", "total_tracks", "release_month",
                           "release_year")) == [
        ("t1", "album", "L", 9, 6, 2015), ("t2", None, "Independent", 1, 0, 0)
    ]


@pytest.fixture()
def lake_root(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()

    def put(name, columns, lines):
        text = [",".join(f'"{c}"' for c in columns)] + lines
        (raw / name).write_text("\n".join(text) + "\n", encoding="utf-8")

    def track(i, **change):
        values = {**GOOD, "track_id": f"t{i}", **change}
        return ",".join([str(i)] + [f'"{values[n]}"' for n in schemas.RAW_TRACKS])

    put("tracks.csv", ["", *schemas.RAW_TRACKS], [
        track(0), track(1, artist_name="Nobody"), track(2, popularity="bad"), track(3, year="2024"),
        track(3, year="2024"),
    ])
    put("artists.csv", schemas.RAW_ARTISTS, ["1,ABBA,70,100,pop,,", "2,abba,60,50,pop,,"])
    put("albums.csv", schemas.RAW_ALBUMS, [
        't0,Song,1,1,al,"Album, one",LP,9,2015-06-09 00:00:00 UTC,Label,3,1,ABBA'
    ])
    put("charts.csv", schemas.RAW_CHARTS, ["song,Abba,1000,100" + ",1" * 18])
    return LakePaths(str(tmp_path))


def test_the_whole_run(spark, lake_root):
    expected = manifest.expected_files(
        spark, [(n, f"raw/{n}", n, 1) for n in flow.RAW_FILES.values()])
    assert flow.check_raw(spark, lake_root, expected)[1]
    assert not flow.check_raw(spark, lake_root)[1]
    assert spark.read.parquet(lake_root.raw("ingestion_log")).count() == 8
    report = flow.run_flow(
        spark, lake_root, publish_folder=lake_root.curated("published"),
        csv_folder=lake_root.curated("csv"))
    assert len(read_csv(spark, lake_root.curated("csv/agg_hit_vs_nohit")).columns) == 15
    steps = {r["step"]: tuple(r)[1:] for r in report.steps.collect()}
    assert steps["clean_tracks"] == (5, 3, 2)
    assert steps["build_master"] == (3, 3, 0)
    assert (report.matched_artists, report.chart_hits, report.fanout_ok) == (2, 2, True)
    master = spark.read.parquet(lake_root.processed("joined"))
    assert len(master.columns) == 39
    by_id = {r["track_id"]: r for r in master.collect()}
    assert by_id["t0"]["followers"] == 100 and by_id["t0"]["album_name"] == "Album, one"
    assert by_id["t1"]["artist_id"] is None and by_id["t1"]["label"] == "Independent"
    assert by_id["t1"]["is_chart_hit"] == 0 and by_id["t0"]["streams"] == 1000
    assert len(report.tables["fact_popularity"].columns) == 27
    assert len(report.tables["dim_tracks"].columns) == 8
    assert len(spark.read.parquet(lake_root.curated("master_ml")).columns) == 34
    for name, check in flow.key_report(report.tables).items():
        assert rows(check) == [(0, 0, 0)], name
    assert rows(star.sql_recent_trend(spark.table("agg_year"))) == [(2024, 50.0, 1)]


def test_spellings_repeat_tracks_in_the_faithful_run(spark, lake_root):
    report = flow.run_flow(
        spark, lake_root, lake_root.curated("published"), unique_keys=False, hot_share=None
    )
    assert not report.fanout_ok
    assert spark.read.parquet(lake_root.processed("joined")).count() == 5


def test_models_join_the_published_tables(spark, lake_root):
    path = scratch_path(spark, "model-rows")
    numbers = {c: (F.col("id") % (i + 3)).cast("double") for i, c in enumerate(
        [*schemas.AUDIO_FEATURES, *schemas.CONTEXT_FEATURES])}
    names = {c: F.concat(F.lit(c), F.col("id") % 5) for c in ["track_name", "artist_name", "genre"]}
    spark.range(300).withColumns({
        **numbers, **names, "track_id": F.col("id").cast("string"),
        "popularity": (F.col("id") % 100).cast("int"),
    }).drop("id").write.parquet(path)
    tables, predictions = flow.train_models(
        spark.read.parquet(path), P.ForestSettings(trees=2, depth=2))
    assert tables["ml_metrics"].count() == 6
    assert tables["ml_feature_importance"].count() == 36
    assert predictions.columns == schemas.PREDICTION_COLUMNS
    for name, check in flow.key_report(tables).items():
        assert rows(check) == [(0, 0, 0)], name


def test_typed_layers_take_the_year_filter_into_the_scan(spark):
    path = scratch_path(spark, "typed")
    cleaning.clean_tracks(raw_tracks(spark, {})).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(stored.filter(F.col("year").between(2009, 2024)).groupBy("year").count())
    assert "GreaterThanOrEqual(year,2009)" in plan
    assert "ReadSchema: struct<year:int>" in plan


def test_albums_join_without_moving_the_deduplicated_tracks_again(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tracks = cleaning.clean_tracks(raw_tracks(spark, {}, {}))
        albums = cleaning.clean_albums(
            spark.createDataFrame([], schemas.text_schema(schemas.RAW_ALBUMS)))
        artists = cleaning.clean_artists(
            spark.createDataFrame([], schemas.text_schema(schemas.RAW_ARTISTS)))
        charts = cleaning.clean_charts(
            spark.createDataFrame([], schemas.text_schema(schemas.RAW_CHARTS)))
        master = build_master(tracks, artists, albums, charts)
        plan = plan_of(master.select("track_id", "album_id"))
        # One shuffle for the tracks and one for the albums, both of the dedup.
        assert plan.count("hashpartitioning(track_id") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_bucketed_layers_join_albums_without_a_shuffle(spark, lake_root):
    plain = flow.run_flow(spark, lake_root, lake_root.curated("p1"))
    wanted = rows(plain.tables["fact_popularity"])
    bucketed = flow.run_flow(spark, lake_root, lake_root.curated("p2"), table_prefix="bucketed")
    assert rows(bucketed.tables["fact_popularity"]) == wanted
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.enrich_albums(
            spark.table("bucketed_tracks"), spark.table("bucketed_albums"))
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_joins_nobody_reads_leave_the_plan(spark):
    tracks = cleaning.typed_tracks(raw_tracks(spark, {}))
    artists = cleaning.clean_artists(
        spark.createDataFrame([], schemas.text_schema(schemas.RAW_ARTISTS)))
    albums = cleaning.clean_albums(
        spark.createDataFrame([], schemas.text_schema(schemas.RAW_ALBUMS)))
    charts = cleaning.clean_charts(
        spark.createDataFrame([], schemas.text_schema(schemas.RAW_CHARTS)))
    path = scratch_path(spark, "dims")
    stored = {}
    for name, df in {"tracks": tracks, "artists": artists, "albums": albums,
                     "charts": charts}.items():
        df.write.parquet(f"{path}/{name}")
        stored[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    master = build_master(stored["tracks"], stored["artists"], stored["albums"], stored["charts"])
    plan = plan_of(master.groupBy("label").agg(F.avg("popularity")))
    assert f"{path}/albums" in plan
    assert f"{path}/artists" not in plan and f"{path}/charts" not in plan


def test_dedup_ranks_before_the_shuffle(spark):
    plan = plan_of(cleaning.clean_tracks(raw_tracks(spark, {}, {})))
    assert plan.count("WindowGroupLimit") >= 2


def test_publish_snapshot_does_not_write_the_master_table(spark, monkeypatch):
    from trackmart.operators.aggregates import GENRE_MEANS
    from trackmart.queries import catalogue

    columns = ["genre string", "is_chart_hit int", *(f"{c} double" for c in GENRE_MEANS)]
    data = [(genre, hit, *[0.5] * len(GENRE_MEANS)) for genre, hit in [("a", 1), ("a", 0), ("b", 1)]]
    made = spark.createDataFrame(data, ", ".join(columns))

    def refuse(df, name):
        raise AssertionError(f"{name} is written")

    monkeypatch.setattr(catalogue, "master", lambda *_, **__: made)
    monkeypatch.setattr(catalogue, "written", refuse)
    found = set(map(tuple, catalogue.publish_snapshot(spark, "none").collect()))
    assert found == {(version, name, 2, 2) for version in (1, 2)
                     for name in ("agg_genre", "agg_hit_vs_nohit")}


def _repeating_tables(spark, entries):
    """Tracks and charts that share a key, with spellings of one artist and a track of no key."""
    tracks = cleaning.typed_tracks(raw_tracks(
        spark, {}, {"track_id": "t2"}, {"track_id": "t3", "track_name": "Other"},
        {"track_id": "t4", "artist_name": None}))
    artists = spark.createDataFrame(
        [("a1", "Abba", 5, 1), ("a2", "ABBA", 6, 2)],
        "artist_id string, artist_name string, artist_popularity int, followers bigint",
    ).withColumns({f"genre_{i}": F.lit(None).cast("string") for i in range(3)})
    albums = cleaning.clean_albums(
        spark.createDataFrame([], schemas.text_schema(schemas.RAW_ALBUMS)))
    charts = spark.range(entries).select(
        F.lit("SONG").alias("track_name"), F.lit("abba").alias("artist_name"),
        *[F.col("id").cast("bigint").alias(c) for c in schemas.CHART_ATTRIBUTES])
    return tracks, artists, albums, charts


@pytest.mark.parametrize("unique_keys", [True, False])
@pytest.mark.parametrize("hot_share", [None, 0.1])
def test_counted_master_stands_for_its_rows(spark, unique_keys, hot_share):
    tables = _repeating_tables(spark, 7)
    whole = build_master(*tables, unique_keys, hot_share).groupBy("track_id").count()
    counted = build_master(*tables, unique_keys, hot_share, counted=True)
    assert rows(counted.select("track_id", "joined_rows")) == rows(whole)
    assert dict(rows(whole))["t1"] == (1 if unique_keys else 14)


def test_counts_of_joined_rows_need_no_joined_rows(spark):
    from trackmart.operators.quality import fanout_report

    tracks, artists, albums, charts = _repeating_tables(spark, 100)
    many = tracks.filter("track_id = 't1'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50))))
    counted = build_master(many, artists, albums, charts, False, counted=True)
    assert counted.count() == 50
    assert tuple(fanout_report(many, counted, times="joined_rows").first()) == (10_000, 50, False)
    nothing = counted.limit(0)
    assert tuple(fanout_report(nothing, nothing, times="joined_rows").first()) == (0, 0, True)


def test_what_charts_do_not_change_is_worked_out_before_they_repeat_rows(spark):
    from trackmart.queries.catalogue import shown

    tables = _repeating_tables(spark, 7)
    whole = build_master(*tables, False)
    viewed = build_master(*tables, False, view=shown)
    assert viewed.columns == whole.columns
    assert rows(viewed) == rows(shown(whole))
    for made in (whole, viewed):
        plan = made.select("followers_log", "streams")._jdf.queryExecution().optimizedPlan()
        after_charts = plan.toString().split("Join", 1)[0]
        assert "followers_log" in after_charts
        assert "LOG1P" not in after_charts and "round(" not in after_charts


@pytest.mark.parametrize("hot_share", [None, 0.1])
def test_master_fills_chart_entries_before_they_repeat_rows(spark, hot_share):
    tracks, artists, albums, charts = _repeating_tables(spark, 5)
    odd = charts.withColumns({c: F.nullif(c, F.lit(2)) for c in schemas.CHART_ATTRIBUTES})
    made = build_master(tracks, artists, albums, odd, False, hot_share)
    entry = made.filter("track_id = 't1'").select(schemas.CHART_ATTRIBUTES).distinct()
    assert rows(entry) == [(0, 0, 0, 0, 0), (0, 0, 0, 1, 0), (1, 1, 1, 1, 1), (3, 3, 3, 3, 3),
                           (4, 4, 4, 4, 4)]
    missed = made.filter("track_id IN ('t3', 't4')").select(schemas.CHART_ATTRIBUTES).distinct()
    assert rows(missed) == [(0, 0, 0, 1, 0)]
    before_join = made._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[0]
    assert "Generate inline" in before_join


def test_published_counts_stores_what_its_tables_read(spark, monkeypatch):
    from trackmart.operators import aggregates
    from trackmart.queries import catalogue

    means = {**aggregates.GENRE_MEANS, **aggregates.YEAR_MEANS, **aggregates.HIT_MEANS}
    columns = ["genre string", "year int", "is_chart_hit int", "album_name string",
               "track_name string", *(f"{c} double" for c in means)]
    data = [(genre, 2000, hit, "x", "y", *[0.5] * len(means)) for genre, hit in [("a", 1), ("b", 0)]]
    made, stored = spark.createDataFrame(data, ", ".join(columns)), []

    def store(df, name):
        stored.append(set(df.columns))
        return df

    monkeypatch.setattr(catalogue, "master", lambda *_, **__: made)
    monkeypatch.setattr(catalogue, "written", store)
    found = rows(catalogue.published_counts(spark, "none"))
    assert found == [("agg_genre", 2, "OK"), ("agg_hit_vs_nohit", 2, "OK"), ("agg_year", 1, "OK"),
                     ("not_published", None, "ERROR")]
    assert stored == [{"genre", "year", "is_chart_hit", *means}]
