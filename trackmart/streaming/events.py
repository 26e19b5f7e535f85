"""Track rows to play events, and event defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.functions.columns import (
    clamp_play_duration,
    safe_float,
    safe_int,
    safe_long,
)
from trackmart.operators.dedup import head_rows
from trackmart.operators.filters import require_text

DEFAULT_DURATION_MS = 180000


def first_tracks(tracks: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """Of the first ``n`` rows, those with a track and an artist name; None means every row."""
    first = tracks if n is None else head_rows(tracks, n, order)
    return require_text(first, ["track_name", "artist_name"])


def _text(df: DataFrame, name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def _number(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def to_events(tracks: DataFrame, sequence: str, at: Column | None = None) -> DataFrame:
    """One play event per track row.

    ``sequence`` is a column that tells rows apart; id and listened time follow
    from it, so a retried task yields the same events. A ``play_duration_ms``
    column, where present, is the listened time. ``at`` is the event time, by
    default the time of the run.
    """
    duration = safe_long(_number(tracks, "duration_ms"), DEFAULT_DURATION_MS)
    lowest = F.least(F.lit(30000).cast("bigint"), duration)
    span = F.greatest(duration - lowest + 1, F.lit(1).cast("bigint"))
    drawn = lowest + F.pmod(F.xxhash64(F.col(sequence)), span)
    listened = (
        safe_long(F.col("play_duration_ms")) if "play_duration_ms" in tracks.columns else drawn
    )
    when = F.current_timestamp() if at is None else at
    fields = {
        "event_id": F.md5(F.col(sequence).cast("string")),
        "timestamp": F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        "track_id": _text(tracks, "track_id", ""),
        "track_name": _text(tracks, "track_name", ""),
        "artist_name": _text(tracks, "artist_name", ""),
        "genre": _text(tracks, "genre", "unknown"),
        "popularity": safe_int(_number(tracks, "popularity")),
        "danceability": safe_float(_number(tracks, "danceability")),
        "energy": safe_float(_number(tracks, "energy")),
        "valence": safe_float(_number(tracks, "valence")),
        "duration_ms": duration,
        "play_duration_ms": clamp_play_duration(listened, duration),
    }
    return tracks.select(*[fields[f.name].alias(f.name) for f in schemas.EVENT.fields])


def event_defaults(events: DataFrame) -> DataFrame:
    """Missing names, genre and listened time replaced by their defaults."""
    return events.fillna({
        "track_name": "Unknown", "artist_name": "Unknown", "genre": "unknown",
        "play_duration_ms": 0,
    })


def with_display_key(events: DataFrame, name: str = "track") -> DataFrame:
    """``track — artist`` as one text."""
    return events.withColumn(name, F.concat_ws(" — ", "track_name", "artist_name"))
