"""Published star schema and the report queries over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from trackmart import schemas
from trackmart.functions.columns import select_existing
from trackmart.operators.dedup import dedup_any
from trackmart.sources.commits import Snapshots
from trackmart.sources.lake import publish


def fact_popularity(model_rows: DataFrame) -> DataFrame:
    return select_existing(model_rows, schemas.FACT_COLUMNS)


def dim_tracks(model_rows: DataFrame) -> DataFrame:
    """One row per track id."""
    return dedup_any(select_existing(model_rows, schemas.DIM_TRACK_COLUMNS), ["track_id"])


def publish_all(tables: Mapping[str, DataFrame], folder: str | None = None) -> dict[str, DataFrame]:
    """Replace every published table; as Parquet and views where a folder is given.

    In a folder the tables are replaced together, as one version: who reads them
    by ``Snapshots`` has all of one run. Tables of the session catalog are
    replaced one by one.
    """
    if folder is None:
        return {name: publish(df, name) for name, df in tables.items()}
    spark = next(iter(tables.values())).sparkSession
    Snapshots(spark, folder).publish(tables)
    return read_published(spark, folder)


def read_published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the newest version in a folder, as views too."""
    published = Snapshots(spark, folder).read()
    for name, df in published.items():
        df.createOrReplaceTempView(name)
    return published


def sql_top_genres(agg_genre: DataFrame, k: int = 5) -> DataFrame:
    return agg_genre.sparkSession.sql(
        "SELECT genre, avg_popularity, track_count, chart_hits FROM {agg_genre} "
        "ORDER BY avg_popularity DESC NULLS LAST, genre LIMIT {k}",
        agg_genre=agg_genre, k=k,
    )


def sql_recent_trend(agg_year: DataFrame, since: int = 2019) -> DataFrame:
    return agg_year.sparkSession.sql(
        "SELECT year, avg_popularity, track_count FROM {agg_year} "
        "WHERE year >= {since} ORDER BY year",
        agg_year=agg_year, since=since,
    )


def sql_hit_compare(agg_hit: DataFrame) -> DataFrame:
    return agg_hit.sparkSession.sql(
        "SELECT is_chart_hit, track_count, avg_popularity, avg_danceability, avg_energy, "
        "avg_valence FROM {agg_hit} ORDER BY is_chart_hit",
        agg_hit=agg_hit,
    )


def sql_model_compare(ml_metrics: DataFrame) -> DataFrame:
    return ml_metrics.sparkSession.sql(
        "SELECT model_name, metric, round(value, 4) AS value FROM {ml_metrics} "
        "ORDER BY model_name, metric",
        ml_metrics=ml_metrics,
    )
