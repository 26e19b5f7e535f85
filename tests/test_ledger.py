"""Runs that stop and go on, and what is foretold before a join."""

import pytest
from pyspark.sql import functions as F
from table_rows import rows
from test_plans import lake_root  # noqa: F401

from trackmart.operators import quality
from trackmart.plans import flow
from trackmart.plans.ledger import StoppedRun


def counted(monkeypatch):
    """How often each file is cleaned."""
    done = []
    cleaners = {
        name: (lambda raw, n=name, clean=clean: done.append(n) or clean(raw))
        for name, clean in flow.CLEANERS.items()
    }
    monkeypatch.setattr(flow, "CLEANERS", cleaners)
    return done


def test_a_resumed_run_does_not_repeat_steps(spark, lake_root, monkeypatch):  # noqa: F811
    done = counted(monkeypatch)
    published = lake_root.curated("published")

    def broken(raw):
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setitem(flow.CLEANERS, "artists", broken)
        with pytest.raises(OSError):
            flow.run_flow(spark, lake_root, published)
    assert done == ["tracks", "charts"]
    report = flow.run_flow(spark, lake_root, published, resume=True)
    assert done == ["tracks", "charts", "artists", "albums"]
    assert report.reused == ["clean_tracks", "clean_charts"]
    fresh = flow.run_flow(spark, lake_root, lake_root.curated("other"))
    assert fresh.reused == [] and len(done) == 8
    assert rows(report.steps) == rows(fresh.steps)
    assert rows(report.tables["fact_popularity"]) == rows(fresh.tables["fact_popularity"])
    again = flow.run_flow(spark, lake_root, lake_root.curated("other"), resume=True)
    assert len(done) == 8 and "publish" in again.reused and "build_master" in again.reused
    assert rows(again.tables["agg_genre"]) == rows(fresh.tables["agg_genre"])
    log = spark.read.parquet(lake_root.raw("ingestion_log"))
    assert log.select("run_id").distinct().count() == 4


def test_a_changed_file_is_read_again(spark, lake_root, monkeypatch):  # noqa: F811
    done = counted(monkeypatch)
    with pytest.raises(StoppedRun):
        flow.run_flow(spark, lake_root, lake_root.curated("p"), until="build_master")
    with open(lake_root.raw("artists.csv"), "a", encoding="utf-8") as file:
        file.write("3,Nobody,10,5,rock,,\n")
    report = flow.run_flow(spark, lake_root, lake_root.curated("p"), resume=True)
    assert done == ["tracks", "charts", "artists", "albums", "artists"]
    assert report.reused == ["clean_tracks", "clean_charts", "clean_albums"]
    assert report.matched_artists == 3


def test_a_missing_file_stops_the_run(spark, lake_root):  # noqa: F811
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        flow.run_flow(spark, lake_root, files={**flow.RAW_FILES, "albums": "nowhere.csv"})


def test_line_breaks_are_found_and_read(spark, lake_root):  # noqa: F811
    with open(lake_root.raw("artists.csv"), "a", encoding="utf-8") as file:
        file.write('3,"No\nbody",10,5,rock,,\n4,12" mix,10,5,rock,,\n')
    report = flow.run_flow(spark, lake_root, lake_root.curated("p"))
    names = {r["artist_name"] for r in
             spark.read.parquet(lake_root.processed("artists")).collect()}
    assert names == {"ABBA", "abba", "No\nbody", '12" mix'}
    steps = {r["step"]: tuple(r)[1:] for r in report.steps.collect()}
    assert steps["clean_artists"] == (4, 4, 0) and steps["clean_tracks"] == (5, 3, 2)


def test_a_forecast_stops_the_run_before_the_join(spark, lake_root):  # noqa: F811
    with pytest.raises(ValueError, match="3 tracks would become 5 rows"):
        flow.run_flow(spark, lake_root, unique_keys=False, fanout_limit=1.05)
    assert flow.run_flow(spark, lake_root, lake_root.curated("p"), fanout_limit=1.0).fanout_ok


def test_forecast_equals_the_joined_rows(spark):
    left = spark.createDataFrame(
        [(i, f"a{i % 7}" if i % 5 else None, i % 3) for i in range(200)], "id int, a string, b int")
    one = spark.createDataFrame([(f"a{i % 4}", i) for i in range(11)] + [(None, 1)],
                                "a string, x int")
    two = spark.createDataFrame([(f"a{i % 6}", i % 2, i) for i in range(30)],
                                "a string, b int, y int")
    joined = left.join(one, "a", "left").join(two, ["a", "b"], "left").count()
    found = quality.fanout_forecast(left, [(one, ["a"]), (two, ["a", "b"])])
    assert rows(found) == [(200, joined, False)]
    empty = quality.fanout_forecast(left.filter(F.lit(False)), [(one, ["a"])])
    assert rows(empty) == [(0, 0, True)]
