"""Column layouts of the catalogue, event and published tables.

Fixed values: the names and types below are those of the input files and of
the tables a dashboard reads, so they have to stay as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw text columns of each input file.
RAW_TRACKS = [
    "artist_name", "track_name", "track_id", "popularity", "year", "genre",
    "danceability", "energy", "key", "loudness", "mode", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "duration_ms", "time_signature",
]
RAW_ARTISTS = [
    "id", "name", "artist_popularity", "followers", "genre_0", "genre_1", "genre_2",
]
RAW_ALBUMS = [
    "track_id", "track_name", "track_number", "duration_ms", "album_id",
    "album_name", "album_type", "album_popularity", "release_date", "label",
    "total_tracks", "artist_id", "artist_0",
]
CHART_COUNTS = [
    "in_spotify_playlists", "in_spotify_charts", "in_apple_playlists",
    "in_apple_charts", "in_deezer_playlists", "in_deezer_charts",
    "in_shazam_charts", "artist_count", "released_year", "released_month",
    "released_day",
]
CHART_PERCENTAGES = {
    "danceability_%": "danceability",
    "valence_%": "valence",
    "energy_%": "energy",
    "acousticness_%": "acousticness",
    "instrumentalness_%": "instrumentalness",
    "liveness_%": "liveness",
    "speechiness_%": "speechiness",
}
RAW_CHARTS = (
    ["track_name", "artist(s)_name", "streams", "bpm"] + CHART_COUNTS + list(CHART_PERCENTAGES)
)

# Types after cleaning; a column without an entry stays text.
TRACK_TYPES = {
    "popularity": "int", "year": "int", "key": "int", "mode": "int",
    "time_signature": "int", "duration_ms": "bigint", "danceability": "float",
    "energy": "float", "loudness": "float", "speechiness": "float",
    "acousticness": "float", "instrumentalness": "float", "liveness": "float",
    "valence": "float", "tempo": "float",
}
ARTIST_TYPES = {"artist_popularity": "int", "followers": "bigint"}
ALBUM_TYPES = {"album_popularity": "int", "total_tracks": "int", "duration_ms": "bigint"}
CHART_TYPES = {"streams": "bigint", "tempo": "float", **{name: "int" for name in CHART_COUNTS}}

TRACK_REQUIRED = ["artist_name", "track_name", "track_id", "popularity", "year", "genre"]
UNIT_FEATURES = [
    "danceability", "energy", "speechiness", "acousticness", "instrumentalness",
    "liveness", "valence",
]

# Columns each dimension adds to a track.
ARTIST_ATTRIBUTES = [
    "artist_id", "artist_popularity", "followers", "genre_0", "genre_1", "genre_2",
]
ALBUM_ATTRIBUTES = [
    "album_id", "album_name", "album_type", "album_popularity", "label",
    "total_tracks", "release_month", "release_year",
]
CHART_ATTRIBUTES = [
    "streams", "in_spotify_playlists", "in_spotify_charts", "artist_count", "is_chart_hit",
]

# Values an unmatched track receives.
MASTER_FILLS = {
    "artist_popularity": 0, "album_popularity": 0, "total_tracks": 1,
    "release_month": 0, "release_year": 0, "in_spotify_playlists": 0,
    "in_spotify_charts": 0, "artist_count": 1, "is_chart_hit": 0,
    "label": "Independent", "album_type": "unknown", "genre_0": "unknown",
}

MODEL_COLUMNS = [
    "track_id", "track_name", "artist_name", "genre", "popularity",
    "danceability", "energy", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "duration_ms", "key",
    "mode", "time_signature", "year", "release_month", "release_year",
    "followers", "followers_log", "artist_popularity", "album_popularity",
    "album_type", "total_tracks", "label", "genre_0", "is_chart_hit", "streams",
    "in_spotify_playlists", "in_spotify_charts", "artist_count",
]
FACT_COLUMNS = [
    "track_id", "track_name", "artist_name", "genre", "popularity",
    "danceability", "energy", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "duration_ms", "year",
    "release_month", "followers", "followers_log", "artist_popularity",
    "album_popularity", "label", "album_type", "is_chart_hit", "streams",
    "in_spotify_playlists", "genre_0",
]
DIM_TRACK_COLUMNS = [
    "track_id", "track_name", "artist_name", "genre", "year", "duration_ms",
    "is_chart_hit", "streams",
]

# Published tables and the key each one promises.
TABLE_KEYS = {
    "dim_tracks": ["track_id"],
    "dim_artists": ["artist_name"],
    "fact_popularity": ["track_id"],
    "agg_genre": ["genre"],
    "agg_year": ["year"],
    "agg_label": ["label"],
    "agg_hit_vs_nohit": ["is_chart_hit"],
    "ml_metrics": ["model_name", "metric"],
    "ml_feature_importance": ["model_name", "feature"],
}

# Model inputs.
AUDIO_FEATURES = [
    "danceability", "energy", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "duration_ms", "key",
    "mode", "time_signature",
]
CONTEXT_FEATURES = [
    "year", "release_month", "followers_log", "artist_popularity",
    "album_popularity", "total_tracks", "is_chart_hit", "in_spotify_playlists",
    "artist_count",
]
PREDICTION_COLUMNS = [
    "track_name", "artist_name", "genre", "popularity", "predicted_popularity",
    "danceability", "energy", "valence", "followers_log",
]

EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("danceability", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("valence", T.DoubleType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("play_duration_ms", T.LongType()),
])

MANIFEST = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("min_size_bytes", T.LongType()),
])


def text_schema(columns: list[str]) -> T.StructType:
    """Every column as a nullable string."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
