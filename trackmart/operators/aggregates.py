"""Curated aggregates of the master table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.functions.columns import select_existing
from trackmart.operators.dedup import top_k
from trackmart.operators.filters import differs, in_range, require

# The averages each report shows and their decimal places.
GENRE_MEANS = {
    "popularity": 2, "danceability": 3, "energy": 3, "valence": 3,
    "acousticness": 3, "speechiness": 3, "tempo": 1, "loudness": 2,
}
YEAR_MEANS = {
    "popularity": 2, "danceability": 3, "energy": 3, "valence": 3,
    "acousticness": 3, "tempo": 1,
}
LABEL_MEANS = {"popularity": 2, "album_popularity": 2}
HIT_MEANS = {
    "popularity": 2, "danceability": 3, "energy": 3, "valence": 3,
    "acousticness": 3, "speechiness": 3, "instrumentalness": 3, "liveness": 3,
    "tempo": 1, "loudness": 2, "duration_ms": 0, "followers_log": 3,
    "artist_popularity": 2,
}
ARTIST_MEANS = {"danceability": 3, "energy": 3, "valence": 3}


# Whole and decimal places of the numbers that are added up for a mean.
EXACT = "decimal(28,12)"


# FLOAT values below this count exactly in units of 10**-12 as whole numbers of 52 bits; their
# sums are kept in two parts, of which neither overflows below 10**11 rows.
SMALL, UNIT, PART_BITS = 4096.0, 1e12, 26
WHOLE = ("tinyint", "smallint", "int")


def rounded_mean(column: str, places: int, kind: str | None = None) -> Column:
    """The rounded mean, from an exact sum: the same in whatever order the rows come.

    Values count to 12 decimal places. Where one is NaN, infinite or has more
    than 16 whole places, the mean is that of the doubles. With the ``kind`` of
    the column, FLOAT and whole values are added as whole numbers, with the same
    result at a small part of the cost; larger FLOAT values of a group as decimals.
    """
    value = F.col(column)
    if kind in WHOLE:
        total, rows = F.sum(value.cast("bigint")), F.count(value)
        return F.round(_ratio(total.cast("decimal(20,0)"), rows, 16), places).cast("double")
    if kind == "bigint":
        high, low = _parts(value)
        most = 10**16 - 1
        lost = F.count_if(~value.between(-most, most)) > 0
        mean = F.round(_ratio((high + low).cast("decimal(26,0)"), F.count(value), 12), places)
        of_doubles = F.round(F.avg(value.cast("double")), places)
        return F.when(lost, of_doubles).otherwise(mean.cast("double"))
    exact = value.try_cast(EXACT)
    if kind == "float":
        double = value.cast("double")
        small = F.abs(double) < SMALL
        # A FLOAT has 24 bits and the unit 40, 12 of them zero: the product is exact.
        scaled = F.when(small, double * UNIT)
        units = F.when(scaled < 0, -F.floor(0.5 - scaled)).otherwise(F.floor(scaled + 0.5))
        high, low = _parts(units)
        total = high + low
        mean = F.round(_ratio(total, F.count(value), 4), places - 12).cast("double") / UNIT
        large = value.isNotNull() & ~small
        # These columns are empty but for the large values, which then count as decimals.
        some = F.count_if(large) > 0
        lost = F.count_if(large & exact.isNull()) > 0
        sums = F.sum(F.when(large, exact)).cast("decimal(37,12)")
        rest = (F.coalesce(total, F.lit(0)).cast("decimal(25,0)")
                * F.lit("0.000000000001").cast("decimal(12,12)")).cast("decimal(37,12)")
        both = F.round(_ratio(rest + sums, F.count(value), 12), places).cast("double")
        of_doubles = F.round(F.avg(double), places)
        return F.when(lost, of_doubles).when(some, both).otherwise(mean)
    lost = F.count_if(value.isNotNull() & exact.isNull()) > 0
    mean = F.round(F.avg(exact), places).cast("double")
    return F.when(lost, F.round(F.avg(value.cast("double")), places)).otherwise(mean)


def _parts(units: Column) -> tuple[Column, Column]:
    """Two exact decimals that add up to the sum of whole numbers."""
    high = F.sum(F.shiftright(units, PART_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << PART_BITS) - 1))).cast("decimal(20,0)")
    return high * F.lit(1 << PART_BITS).cast("decimal(8,0)"), low


def _ratio(total: Column, rows: Column, places: int) -> Column:
    """An exact sum by its number of rows as a decimal, NULL without rows."""
    ratio = total / F.nullif(rows, F.lit(0).cast("bigint")).cast("decimal(18,0)")
    return ratio.cast(f"decimal({min(38, 22 + places)},{places})")


def rounded_means(df: DataFrame, places: Mapping[str, int]) -> list[Column]:
    """The means of columns of ``df`` as ``avg_<column>``."""
    kinds = dict(df.dtypes)
    return [rounded_mean(c, n, kinds.get(c)).alias(f"avg_{c}") for c, n in places.items()]


def _tracks() -> Column:
    return F.count(F.lit(1)).alias("track_count")


def _hits() -> Column:
    return F.sum("is_chart_hit").alias("chart_hits")


def _streams() -> Column:
    return F.sum("streams").alias("total_streams")


def agg_genre(master: DataFrame) -> DataFrame:
    """Audio profile and hits per genre, most tracks first."""
    by_genre = master.groupBy("genre").agg(_tracks(), *rounded_means(master, GENRE_MEANS), _hits())
    return by_genre.orderBy(F.desc("track_count"), F.asc_nulls_last("genre"))


def agg_year(master: DataFrame, low: int = 2009, high: int = 2024) -> DataFrame:
    """Yearly trend between two years, both included."""
    years = in_range(master, "year", low, high)
    by_year = years.groupBy("year").agg(_tracks(), *rounded_means(years, YEAR_MEANS), _hits())
    return by_year.orderBy("year")


def agg_label(master: DataFrame, k: int = 30) -> DataFrame:
    """The ``k`` labels with the highest rounded popularity, ties by name."""
    signed = differs(master, "label", "Independent")
    by_label = signed.groupBy("label").agg(
        _tracks(), *rounded_means(signed, LABEL_MEANS), _hits(), _streams()
    )
    return top_k(by_label, k, [F.desc_nulls_last("avg_popularity"), F.asc("label")])


def agg_hit(master: DataFrame) -> DataFrame:
    """Chart hits against all other tracks."""
    by_flag = master.groupBy("is_chart_hit").agg(_tracks(), *rounded_means(master, HIT_MEANS))
    return by_flag.orderBy("is_chart_hit")


def artist_profiles(master: DataFrame) -> DataFrame:
    """Tracks, popularity, hits and audio means of every artist."""
    kinds = dict(master.dtypes)
    return master.groupBy("artist_name").agg(
        _tracks(),
        rounded_mean("popularity", 2, kinds.get("popularity")).alias("avg_popularity"),
        F.max("followers").alias("followers"),
        rounded_mean("artist_popularity", 1, kinds.get("artist_popularity")).alias("artist_popularity"),
        _hits(),
        _streams(),
        *rounded_means(master, ARTIST_MEANS),
    )


def agg_artist(master: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` artists with the highest rounded popularity, ties by name."""
    return top_artists(artist_profiles(master), k)


def top_artists(profiles: DataFrame, k: int = 50) -> DataFrame:
    """``agg_artist`` from the profiles of all artists."""
    return top_k(profiles, k, [F.desc_nulls_last("avg_popularity"), F.asc_nulls_last("artist_name")])


def master_ml(master: DataFrame) -> DataFrame:
    """Model-ready projection: the model columns that exist, target present."""
    return require(select_existing(master, schemas.MODEL_COLUMNS), ["popularity"])
