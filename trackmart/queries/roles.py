"""The driver tables in the roles of tracks, artists, albums, charts and plays.

The text-typed raw datasets are built by SQL expressions that read the same in
Spark and in DuckDB, with padding, odd case, unreadable numbers and missing
values among them. Everything after that is computed by the library on one side
and by plain SQL on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRACKS = {
    "artist_name": "' ' || upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' '",
    "track_name": "p_brand || ' '",
    "track_id": "cast(l_orderkey as string)",
    "popularity": "case when l_returnflag = 'N' and l_linenumber = 7 then 'n/a' "
                  "else cast(cast(l_quantity * 2 as int) as string) end",
    "year": "cast(year(l_shipdate) as string)",
    "genre": "' ' || p_type",
    "danceability": "cast(l_discount as string)",
    "energy": "cast(l_tax as string)",
    "key": "cast(l_linenumber as string)",
    "loudness": "cast(-(l_quantity + cast(p_size as double)) / 8 as string)",
    "mode": "case when l_linestatus = 'O' then '1' else '0' end",
    "speechiness": "cast(l_tax * 5 as string)",
    "acousticness": "cast(1 - l_discount as string)",
    "instrumentalness": "cast(cast(p_size as double) / 50 as string)",
    "liveness": "cast(cast(p_size as double) / 48 as string)",
    "valence": "cast(1 - l_tax as string)",
    "tempo": "cast(p_retailprice / 10 as string)",
    "duration_ms": "cast(cast(floor(l_extendedprice * 3) as bigint) as string)",
    "time_signature": "cast(3 + l_linenumber % 3 as string)",
}
ARTISTS = {
    "id": "p_brand || '/' || p_type || '/' || cast(p_size as string)",
    "name": "case when p_name like 'red %' then null "
            "when p_size % 3 = 0 then upper(p_name) else ' ' || p_name end",
    "artist_popularity": "case when p_size = 7 then 'n/a' when p_size = 50 then '101' "
                         "else cast(p_size * 2 as string) end",
    "followers": "case when p_size = 9 then null else cast(p_partkey * 37 as string) end",
    "genre_0": "case when p_size = 49 then null else p_type end",
    "genre_1": "p_brand",
    "genre_2": "case when p_size > 25 then p_type else null end",
}
ALBUMS = {
    "track_id": "cast(o_orderkey - o_orderkey % 2 as string)",
    "track_name": "o_orderstatus || '-' || cast(o_custkey as string)",
    "track_number": "cast(o_custkey % 12 as string)",
    "duration_ms": "cast(cast(floor(o_totalprice) as bigint) as string)",
    "album_id": "'al-' || cast(o_custkey as string)",
    "album_name": "' Album ' || cast(o_custkey as string)",
    "album_type": "case when o_orderstatus = 'O' then ' SINGLE ' else 'Album' end",
    "album_popularity": "cast(cast(floor(o_totalprice / 5000) as int) as string)",
    "release_date": "case when o_orderstatus = 'P' then substr(cast(o_orderdate as string), 1, 7) "
                    "else cast(o_orderdate as string) || ' UTC' end",
    "label": "case when o_orderpriority = '4-NOT SPECIFIED' then null "
             "else o_orderpriority || ' ' end",
    "total_tracks": "cast(o_custkey % 20 + 1 as string)",
    "artist_id": "cast(o_custkey as string)",
    "artist_0": "'artist ' || cast(o_custkey as string)",
}
CHARTS = {
    "track_name": "case when p_size >= 46 then p_brand || ' ' else p_brand || ' (live)' end",
    "artist(s)_name": "upper(p_name)",
    "streams": "case when p_size = 47 then 'BPM110' when p_size = 48 then null "
               "else cast(p_partkey * 1000 + p_size as string) end",
    "bpm": "cast(p_size + 60 as string)",
    "in_spotify_playlists": "cast(p_size * 3 as string)",
    "in_spotify_charts": "cast(p_size as string)",
    "in_apple_charts": "'1,0' || cast(p_size as string)",
    "artist_count": "cast(1 + p_size % 3 as string)",
    "released_year": "cast(1990 + p_size as string)",
    "danceability_%": "cast(p_size as string)",
    "valence_%": "case when p_size = 49 then 'abc' else cast(p_size * 2 as string) end",
    "energy_%": "cast(100 - p_size as string)",
}
PLAYS = {
    "event_id": "cast(event_id as string)",
    "timestamp": "cast(ts as string)",
    "track_id": "cast(user_id as string)",
    "track_name": "'Track ' || cast(user_id as string)",
    "artist_name": "case when user_id % 7 = 0 then null "
                   "else 'Artist with a rather long name, number ' || cast(user_id % 10 as string) end",
    "genre": "case when event_type = 'error' then null else event_type end",
    "popularity": "cast(user_id % 101 as int)",
    "danceability": "value / 500",
    "energy": "value / 1000",
    "valence": "1 - value / 1000",
    "duration_ms": "cast(300000 as bigint)",
    "play_duration_ms": "cast(floor(value * 1000) as bigint)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shape(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def raw_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return _shape(lines.join(parts, lines.l_partkey == parts.p_partkey), TRACKS)


def raw_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(table(spark, sf_dir, "part"), ARTISTS)


def raw_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(table(spark, sf_dir, "orders"), ALBUMS)


def raw_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(table(spark, sf_dir, "part"), CHARTS)


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(table(spark, sf_dir, "events"), PLAYS)


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f'{text} AS "{name}"' for name, text in columns.items())


def rounded(value: str, places: int) -> str:
    """SQL for a HALF_UP rounding of a double that agrees with Spark's."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {places}) AS DOUBLE)"


def widened(columns: list[str], rest: str = "") -> str:
    """SQL for all columns with the listed FLOAT ones as DOUBLE."""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"* REPLACE ({casts}{rest})"


def _types(names: list[str], target: str) -> str:
    return ", ".join(f"TRY_CAST({n} AS {target}) AS {n}" for n in names)


FLOATS = [
    "danceability", "energy", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo",
]
_TRACK_CASTS = (
    "trim(artist_name) AS artist_name, trim(track_name) AS track_name, track_id, "
    "TRY_CAST(popularity AS INTEGER) AS popularity, TRY_CAST(year AS INTEGER) AS year, "
    "trim(lower(genre)) AS genre, TRY_CAST(duration_ms AS BIGINT) AS duration_ms, "
    + _types(["key", "mode", "time_signature"], "INTEGER") + ", " + _types(FLOATS, "FLOAT")
)


def _first_per(source: str, key: str, columns: list[str], where: str) -> str:
    order = ", ".join(f'"{c}" NULLS LAST' for c in columns if c != key)
    return (
        f"SELECT * EXCLUDE (_rank) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS _rank FROM {source} WHERE {where}) "
        "WHERE _rank = 1"
    )


# One WITH clause that all catalogue oracles share; DuckDB runs what is used.
CTES = {
    "raw_tracks": f"SELECT {_listed(TRACKS)} FROM lineitem JOIN part ON l_partkey = p_partkey",
    "raw_artists": f"SELECT {_listed(ARTISTS)} FROM part",
    "raw_albums": f"SELECT {_listed(ALBUMS)} FROM orders",
    "raw_charts": f"SELECT {_listed(CHARTS)} FROM part",
    "plays": f"SELECT {_listed(PLAYS)} FROM events",
    "tracks": f"SELECT {_TRACK_CASTS} FROM raw_tracks",
    "first_tracks": _first_per(
        "raw_tracks", "track_id", list(TRACKS),
        "artist_name IS NOT NULL AND track_name IS NOT NULL AND track_id IS NOT NULL "
        "AND popularity IS NOT NULL AND year IS NOT NULL AND genre IS NOT NULL",
    ),
    "clean_tracks": (
        f"SELECT * FROM (SELECT {_TRACK_CASTS} FROM first_tracks) "
        "WHERE popularity BETWEEN 0 AND 100 AND duration_ms >= 30000 "
        "AND year BETWEEN 1900 AND 2025 AND danceability BETWEEN 0 AND 1 "
        "AND energy BETWEEN 0 AND 1 AND speechiness BETWEEN 0 AND 1 "
        "AND acousticness BETWEEN 0 AND 1 AND instrumentalness BETWEEN 0 AND 1 "
        "AND liveness BETWEEN 0 AND 1 AND valence BETWEEN 0 AND 1"
    ),
    "named_artists": "SELECT * RENAME (id AS artist_id, name AS artist_name) FROM raw_artists",
    "first_artists": _first_per(
        "named_artists", "artist_id",
        ["artist_id", "artist_name", "artist_popularity", "followers", "genre_0", "genre_1",
         "genre_2"],
        "artist_id IS NOT NULL AND artist_name IS NOT NULL",
    ),
    "clean_artists": (
        "SELECT artist_id, trim(artist_name) AS artist_name, "
        "coalesce(TRY_CAST(artist_popularity AS INTEGER), 0) AS artist_popularity, "
        "coalesce(TRY_CAST(followers AS BIGINT), 0) AS followers, genre_0, genre_1, genre_2 "
        "FROM first_artists WHERE TRY_CAST(artist_popularity AS INTEGER) IS NULL "
        "OR TRY_CAST(artist_popularity AS INTEGER) BETWEEN 0 AND 100"
    ),
    "first_albums": _first_per(
        "raw_albums", "track_id", list(ALBUMS), "track_id IS NOT NULL AND track_name IS NOT NULL"
    ),
    "dated_albums": (
        "SELECT *, try_strptime(regexp_replace(release_date, ' UTC$', ''), '%Y-%m-%d %H:%M:%S') "
        "AS released FROM first_albums"
    ),
    "clean_albums": (
        "SELECT track_id, trim(track_name) AS track_name, track_number, "
        "TRY_CAST(duration_ms AS BIGINT) AS duration_ms, album_id, "
        "trim(album_name) AS album_name, trim(lower(album_type)) AS album_type, "
        "coalesce(TRY_CAST(album_popularity AS INTEGER), 0) AS album_popularity, "
        "CAST(released AS VARCHAR) AS release_date, "
        "coalesce(trim(label), 'Independent') AS label, "
        "coalesce(TRY_CAST(total_tracks AS INTEGER), 1) AS total_tracks, artist_id, artist_0, "
        "coalesce(CAST(month(released) AS INTEGER), 0) AS release_month, "
        "coalesce(CAST(year(released) AS INTEGER), 0) AS release_year FROM dated_albums"
    ),
    "clean_charts": (
        'SELECT trim(track_name) AS track_name, trim("artist(s)_name") AS artist_name, '
        "TRY_CAST(streams AS BIGINT) AS streams, TRY_CAST(bpm AS FLOAT) AS tempo, "
        "TRY_CAST(in_spotify_playlists AS INTEGER) AS in_spotify_playlists, "
        "TRY_CAST(in_spotify_charts AS INTEGER) AS in_spotify_charts, "
        "CAST(NULL AS INTEGER) AS in_apple_charts, "
        "TRY_CAST(artist_count AS INTEGER) AS artist_count, "
        "TRY_CAST(released_year AS INTEGER) AS released_year, "
        'CAST(TRY_CAST("danceability_%" AS FLOAT) AS DOUBLE) / 100 AS danceability, '
        'CAST(TRY_CAST("valence_%" AS FLOAT) AS DOUBLE) / 100 AS valence, '
        'CAST(TRY_CAST("energy_%" AS FLOAT) AS DOUBLE) / 100 AS energy, '
        "1 AS is_chart_hit FROM raw_charts WHERE track_name IS NOT NULL "
        'AND "artist(s)_name" IS NOT NULL AND streams IS NOT NULL'
    ),
}


def _artist_dim(key: str) -> str:
    return (
        "SELECT lower(artist_name) AS join_artist, artist_id, artist_popularity, followers, "
        "genre_0, genre_1, genre_2 FROM (SELECT *, row_number() OVER (PARTITION BY "
        f"{key} ORDER BY artist_popularity DESC NULLS LAST, followers DESC NULLS LAST, "
        "artist_name DESC, artist_id DESC, genre_0 DESC NULLS LAST, genre_1 DESC NULLS LAST, "
        "genre_2 DESC NULLS LAST) AS _rank FROM clean_artists) WHERE _rank = 1"
    )


_CHART_SLIM = (
    "SELECT lower(track_name) AS join_track, lower(artist_name) AS join_artist, streams, "
    "in_spotify_playlists, in_spotify_charts, artist_count, is_chart_hit FROM clean_charts"
)
CTES.update({
    "artist_dim": _artist_dim("lower(artist_name)"),
    "artist_dim_all": _artist_dim("artist_name"),
    # Clean albums hold one row per track already.
    "album_dim": (
        "SELECT track_id, album_id, album_name, album_type, album_popularity, label, "
        "total_tracks, release_month, release_year FROM clean_albums"
    ),
    "chart_dim_all": _CHART_SLIM,
    "chart_dim": (
        "SELECT * EXCLUDE (_rank) FROM (SELECT *, row_number() OVER (PARTITION BY join_track, "
        "join_artist ORDER BY streams DESC NULLS LAST, in_spotify_playlists DESC NULLS LAST, "
        "in_spotify_charts DESC NULLS LAST, artist_count DESC NULLS LAST) AS _rank "
        "FROM chart_dim_all) WHERE _rank = 1"
    ),
})


def _master(artist_dim: str, chart_dim: str, tracks: str = "tracks") -> str:
    return (
        "SELECT t.*, a.artist_id, coalesce(a.artist_popularity, 0) AS artist_popularity, "
        "coalesce(a.followers, 0) AS followers, coalesce(a.genre_0, 'unknown') AS genre_0, "
        "a.genre_1, a.genre_2, b.album_id, b.album_name, "
        "coalesce(b.album_type, 'unknown') AS album_type, "
        "coalesce(b.album_popularity, 0) AS album_popularity, "
        "coalesce(b.label, 'Independent') AS label, coalesce(b.total_tracks, 1) AS total_tracks, "
        "coalesce(b.release_month, 0) AS release_month, "
        "coalesce(b.release_year, 0) AS release_year, coalesce(c.streams, 0) AS streams, "
        "coalesce(c.in_spotify_playlists, 0) AS in_spotify_playlists, "
        "coalesce(c.in_spotify_charts, 0) AS in_spotify_charts, "
        "coalesce(c.artist_count, 1) AS artist_count, "
        "coalesce(c.is_chart_hit, 0) AS is_chart_hit, "
        "ln(1 + CAST(coalesce(a.followers, 0) AS DOUBLE)) AS followers_log "
        f"FROM {tracks} t LEFT JOIN {artist_dim} a ON lower(t.artist_name) = a.join_artist "
        "LEFT JOIN album_dim b ON t.track_id = b.track_id "
        f"LEFT JOIN {chart_dim} c ON lower(t.track_name) = c.join_track "
        "AND lower(t.artist_name) = c.join_artist"
    )


CTES.update({
    "master": _master("artist_dim", "chart_dim"),
    "master_all": _master("artist_dim_all", "chart_dim_all"),
    "clean_master": _master("artist_dim", "chart_dim", "clean_tracks"),
    "clean_master_all": _master("artist_dim_all", "chart_dim_all", "clean_tracks"),
})


def with_roles(query: str) -> str:
    """The query after the WITH clause of the roles."""
    return "WITH " + ", ".join(f"{name} AS ({text})" for name, text in CTES.items()) + " " + query
