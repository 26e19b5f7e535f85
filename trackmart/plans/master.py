"""The master table: tracks with artist, album and chart attributes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.functions.columns import coalesce_zero, fill_nulls, with_log1p
from trackmart.operators.joins import (
    album_dimension,
    artist_dimension,
    chart_dimension,
    hot_key_hashes,
    left_join,
    match_counts,
    repeating_join,
    with_join_keys,
)
from trackmart.operators.quality import fanout_forecast

ARTIST_KEY = ["join_artist"]
CHART_KEY = ["join_track", "join_artist"]
JOINED_ROWS = "joined_rows"


def build_master(
    tracks: DataFrame,
    artists: DataFrame,
    albums: DataFrame,
    charts: DataFrame,
    unique_keys: bool = True,
    hot_share: float | None = None,
    counted: bool = False,
    view: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Three left joins, fills, and the log of followers.

    With ``unique_keys`` the result has exactly the rows of ``tracks``. With
    ``hot_share`` names holding more than that share of the tracks are found
    first and their joins salted, for dimensions too large to broadcast; without
    it, Spark splits skewed join partitions at run time.

    ``counted`` gives each track once, with how many rows it has in the result
    as ``joined_rows``, in place of these rows: where keys repeat on both sides,
    rows grow with the square of the input, these counts in proportion to it.

    The charts join last, as their entries repeat rows the most: all that does
    not read them is worked out before, once for all the rows that it repeats in.
    So is ``view``, a projection of the columns that charts do not bring.
    """
    keyed = with_join_keys(tracks)
    hot = {"artist": [], "chart": []}
    if hot_share is not None:
        hot = hot_key_hashes(keyed, {"artist": ARTIST_KEY, "chart": CHART_KEY}, hot_share)
    # Albums first: tracks straight from their dedup are already spread by track id.
    joined = left_join(keyed, album_dimension(albums), ["track_id"])
    by_artist, by_chart = artist_dimension(artists, unique_keys), chart_dimension(charts, unique_keys)
    if counted:
        by_artist = match_counts(by_artist, ARTIST_KEY, "_artists")
        by_chart = match_counts(by_chart, CHART_KEY, "_charts")
    joined = left_join(joined, by_artist, ARTIST_KEY, hot["artist"])
    if not counted:
        filled = coalesce_zero(fill_nulls(joined, schemas.MASTER_FILLS), ["followers"])
        joined = with_log1p(filled, "followers", "followers_log")
        joined = joined if view is None else view(joined)
    if counted:
        joined = left_join(joined, by_chart, CHART_KEY, hot["chart"])
        times = F.coalesce("_artists", F.lit(1)) * F.coalesce("_charts", F.lit(1))
        return joined.select(*tracks.columns, times.alias(JOINED_ROWS))
    of_charts = {c: v for c, v in schemas.MASTER_FILLS.items() if c in schemas.CHART_ATTRIBUTES}

    def filled_entries(df: DataFrame) -> DataFrame:
        return coalesce_zero(fill_nulls(df, of_charts), ["streams"])

    columns = [
        *tracks.columns, *schemas.ARTIST_ATTRIBUTES, *schemas.ALBUM_ATTRIBUTES,
        *schemas.CHART_ATTRIBUTES, "followers_log",
    ]
    if unique_keys:
        joined = filled_entries(left_join(joined, by_chart, CHART_KEY, hot["chart"]))
    else:  # filled once, not in each row that an entry comes in
        joined = repeating_join(joined, filled_entries(by_chart), CHART_KEY, hot["chart"],
                                {"streams": 0, **of_charts})
    return joined.select(columns)


def master_forecast(
    tracks: DataFrame, artists: DataFrame, charts: DataFrame, unique_keys: bool = True
) -> DataFrame:
    """The rows that ``build_master`` will have, foretold from counts per key.

    A track has one album at most, whatever the albums hold.
    """
    return fanout_forecast(with_join_keys(tracks), [
        (artist_dimension(artists, unique_keys), ARTIST_KEY),
        (chart_dimension(charts, unique_keys), CHART_KEY),
    ])
