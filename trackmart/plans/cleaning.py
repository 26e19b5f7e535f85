"""Raw text tables to clean typed tables.

Every plan is one lazy chain. Where a table is deduplicated, that comes before
the casts and range filters: a key whose kept row turns out invalid is gone even
if another of its rows was valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.functions.columns import (
    cast_columns,
    fill_nulls,
    normalize_text,
    parse_release_date,
    percent_to_fraction,
    rename,
    select_existing,
    trim_columns,
    with_flag,
)
from trackmart.operators.dedup import dedup_any
from trackmart.operators.filters import at_least, in_range, in_range_or_null, require

# Accepted ranges.
POPULARITY = (0, 100)
YEARS = (1900, 2025)
UNIT = (0.0, 1.0)
SHORTEST_MS = 30000


def _tidy_tracks(typed: DataFrame) -> DataFrame:
    trimmed = trim_columns(typed, ["artist_name", "track_name"])
    return normalize_text(trimmed, ["genre"]).drop("_c0")


def typed_tracks(raw: DataFrame, truncate_decimals: bool = False) -> DataFrame:
    """Casts and text clean-up of tracks without removing any row."""
    return _tidy_tracks(cast_columns(raw, schemas.TRACK_TYPES, truncate_decimals))


def clean_tracks(raw: DataFrame, truncate_decimals: bool = False) -> DataFrame:
    """Required fields, one row per track id, typed, in range, tidy text."""
    kept = dedup_any(require(raw, schemas.TRACK_REQUIRED), ["track_id"])
    typed = cast_columns(kept, schemas.TRACK_TYPES, truncate_decimals)
    valid = in_range(typed, "popularity", *POPULARITY)
    valid = at_least(valid, "duration_ms", SHORTEST_MS)
    valid = in_range(valid, "year", *YEARS)
    for feature in schemas.UNIT_FEATURES:
        valid = in_range(valid, feature, *UNIT)
    return _tidy_tracks(valid)


def clean_charts(raw: DataFrame, truncate_decimals: bool = False) -> DataFrame:
    """Chart entries, typed, percentages as fractions, flagged as hits.

    A stream count that does not convert stays as NULL.
    """
    kept = raw.filter(
        F.col("track_name").isNotNull()
        & F.col("`artist(s)_name`").isNotNull()
        & F.col("streams").isNotNull()
    )
    named = rename(kept, {"artist(s)_name": "artist_name", "bpm": "tempo"})
    typed = cast_columns(named, schemas.CHART_TYPES, truncate_decimals)
    scaled = percent_to_fraction(typed, schemas.CHART_PERCENTAGES)
    return with_flag(trim_columns(scaled, ["track_name", "artist_name"]), "is_chart_hit")


def clean_artists(raw: DataFrame, truncate_decimals: bool = False) -> DataFrame:
    """One row per artist id; unknown popularity and followers become 0."""
    named = rename(raw, {"id": "artist_id", "name": "artist_name"})
    kept = dedup_any(require(named, ["artist_id", "artist_name"]), ["artist_id"])
    typed = cast_columns(kept, schemas.ARTIST_TYPES, truncate_decimals)
    valid = in_range_or_null(typed, "artist_popularity", *POPULARITY)
    return fill_nulls(
        trim_columns(valid, ["artist_name"]), {"followers": 0, "artist_popularity": 0}
    )


def clean_albums(raw: DataFrame, truncate_decimals: bool = False) -> DataFrame:
    """One row per track id with its album, release month and year."""
    slim = select_existing(raw, schemas.RAW_ALBUMS)
    kept = dedup_any(require(slim, ["track_id", "track_name"]), ["track_id"])
    typed = cast_columns(kept, schemas.ALBUM_TYPES, truncate_decimals)
    dated = parse_release_date(typed)
    tidy = normalize_text(
        trim_columns(dated, ["track_name", "album_name", "label"]), ["album_type"]
    )
    return fill_nulls(tidy, {
        "label": "Independent", "album_popularity": 0, "total_tracks": 1,
        "release_month": 0, "release_year": 0,
    })
