"""Every registered query against its SQL on the smallest data."""

import contextlib
import io

import pytest

from oracle import DATA, compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = f"{DATA}0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", [
    "clean_tracks", "join_artists_salted", "master_table", "master_table_repeating", "agg_artist",
    "fanout_guard", "dim_tracks", "baseline_metrics", "batch_summary", "top_tracks", "event_records",
])
def test_plans_pair_no_rows_without_a_key_and_run_no_python(spark, name):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        QUERIES[name](spark, SF_DIR).explain()
    for operator in ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"]:
        assert operator not in text.getvalue()


@pytest.mark.parametrize("name", ["split_counts", "assembled_rows", "agg_genre"])
def test_tracks_are_read_once(spark, name):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        QUERIES[name](spark, SF_DIR).explain()
    assert text.getvalue().count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
