"""Queries over the catalogue roles: sources, cleaning, joins, aggregates, reports."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.functions import columns as C
from trackmart.ml import popularity as P
from trackmart.ml.popularity import ForestSettings
from trackmart.operators import aggregates, dedup, filters, joins, quality
from trackmart.plans import cleaning, flow, star
from trackmart.plans.ledger import StoppedRun
from trackmart.plans.master import JOINED_ROWS, build_master, master_forecast
from trackmart.queries import roles
from trackmart.queries.roles import FLOATS, rounded, widened, with_roles
from trackmart.session import scratch_path, written
from trackmart.sources import lake, manifest
from trackmart.sources.commits import Snapshots

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL where there is one."""
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = with_roles(sql)
        return function
    return register


def shown(df: DataFrame) -> DataFrame:
    """FLOAT columns as DOUBLE and the log feature rounded, to compare with SQL."""
    values = {name: F.col(name).cast("double") for name, kind in df.dtypes if kind == "float"}
    if "followers_log" in df.columns:
        values["followers_log"] = F.round("followers_log", 6)
    return df.withColumns(values)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed tracks, every row."""
    return cleaning.typed_tracks(roles.raw_tracks(spark, sf_dir))


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_artists(roles.raw_artists(spark, sf_dir))


def albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_albums(roles.raw_albums(spark, sf_dir))


def charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_charts(roles.raw_charts(spark, sf_dir))


def master(
    spark: SparkSession, sf_dir: str, unique_keys: bool = True, hot_share: float | None = None,
    counted: bool = False, view: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    return build_master(
        tracks(spark, sf_dir), artists(spark, sf_dir), albums(spark, sf_dir),
        charts(spark, sf_dir), unique_keys, hot_share, counted, view,
    )


# Sources and sinks ---------------------------------------------------------

_AWKWARD = "album_name || ', \"live\"' || chr(10) || 'disc'"


@query(f"SELECT * REPLACE ({_AWKWARD} AS album_name) FROM raw_albums")
def csv_scan(spark, sf_dir):
    """Commas, quotes and line breaks survive the way to CSV and back; the file's columns stand
    in another order than the wanted ones."""
    path = scratch_path(spark, "csv")
    raw = roles.raw_albums(spark, sf_dir).select(sorted(schemas.RAW_ALBUMS, reverse=True))
    lake.export_csv(raw.withColumn("album_name", F.expr(_AWKWARD)), path)
    return lake.read_csv(spark, path, schemas.RAW_ALBUMS, multi_line=True)


@query(
    "SELECT CAST(p_partkey AS VARCHAR) AS part, p_name AS name, nullif(p_type, 'SMALL') AS kind "
    "FROM part "
    "WHERE p_type <> 'PROMO' AND p_size % 5 <> 0"
)
def csv_tolerant_scan(spark, sf_dir):
    """Lines with fields too many are skipped, blank ones counted; short lines are kept."""
    parts = roles.table(spark, sf_dir, "part")
    line = F.concat_ws(
        ",", F.col("p_partkey").cast("string"), "p_name", F.expr("nullif(p_type, 'SMALL')"),
        F.when(F.col("p_type") == "PROMO", F.lit("stray")),
        F.expr("case when p_size % 10 = 0 then ',x' when p_size % 5 = 0 then ',' end"),
    )
    path = scratch_path(spark, "lines")
    parts.select(line.alias("value")).write.text(path)
    reader_columns = ["part", "name", "kind"]
    return lake.read_csv(spark, path, reader_columns, skip_long_lines=True, header=False)


@query("SELECT count(*) AS broken_lines FROM part WHERE p_size % 4 = 0")
def csv_broken_quotes(spark, sf_dir):
    """Lines that do not close a quote, among lines with quoted quotes and commas."""
    parts = roles.table(spark, sf_dir, "part")
    line = F.concat(
        F.lit('"a ""b"", c",'), "p_name", F.expr("case when p_size % 4 = 0 then ',\"open' else '' end"),
    )
    path = scratch_path(spark, "quotes")
    parts.select(line.alias("value")).write.text(path)
    return lake.broken_quotes(spark, path)


@query(
    "SELECT album_id, track_id, CASE WHEN CAST(track_id AS BIGINT) % 7 <> 0 THEN "
    "CASE WHEN CAST(track_id AS BIGINT) % 3 = 0 THEN trim(album_name) || chr(10) || 'disc \"2\", live' "
    "|| chr(10) ELSE trim(album_name) || ' 12\" mix' END END AS album_name FROM raw_albums"
)
def csv_multiline_scan(spark, sf_dir):
    """Every third record has line breaks, commas and quotes inside quotes; others have quotes
    inside a field without quotes, and every seventh one opens a quote that nothing closes."""
    raw = roles.raw_albums(spark, sf_dir)
    number, name = F.col("track_id").cast("bigint"), F.trim("album_name")
    field = (
        F.when(number % 7 == 0, F.concat(F.lit('"stray '), name))
        .when(number % 3 == 0, F.concat(F.lit('"'), name, F.lit('\ndisc ""2"", live\n"')))
        .otherwise(F.concat(name, F.lit(' 12" mix')))
    )
    line = F.concat_ws(",", "album_id", "track_id", field)
    path = scratch_path(spark, "multi-line")
    raw.select(line.alias("value")).write.text(path)
    names = ["album_id", "track_id", "album_name"]
    found = lake.read_csv(spark, path, names, multi_line=True, header=False)
    known = F.col("track_id").cast("bigint") % 7 != 0
    return found.withColumn("album_name", F.when(known, F.col("album_name")))


# A manifest as large as the data: every part is an expected file, and an order for every second
# customer of the same number says that it is there and how large.
_LISTED = (
    "(SELECT p_name AS file, 'raw/' || p_partkey || '.csv' AS path, p_type AS description, "
    "CAST(p_size AS BIGINT) * 5000 AS least, s.size FROM part LEFT JOIN (SELECT o_custkey AS k, "
    "max(CAST(floor(o_totalprice * (o_custkey % 4000)) AS BIGINT)) AS size FROM orders "
    "GROUP BY o_custkey) s ON p_partkey = s.k)"
)
_SIZE = (
    "CASE WHEN {0} >= 1000000000 THEN printf('%.2f GB', {0} / 1e9) "
    "WHEN {0} >= 1000000 THEN printf('%.2f MB', {0} / 1e6) "
    "WHEN {0} >= 1000 THEN printf('%.2f KB', {0} / 1e3) ELSE {0}::VARCHAR || ' B' END"
)
_STATUS = (
    "(SELECT file, path, description, CASE WHEN size IS NULL THEN 'MISSING' WHEN size < least "
    "THEN 'WARNING — file smaller than expected' ELSE 'OK' END AS status, CASE WHEN size IS NULL "
    f"THEN '—' ELSE {_SIZE.format('size')} END AS size, CASE WHEN size IS NULL THEN "
    "'Not in the raw layer: add the file, then run again.' WHEN size < least THEN "
    f"'At least ' || {_SIZE.format('least')} || ' are due: the file is cut or another one.' "
    f"ELSE 'Present with its full size.' END AS note FROM {_LISTED})"
)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, orders = roles.table(spark, sf_dir, "part"), roles.table(spark, sf_dir, "orders")

    def path(key: str) -> Column:
        return F.concat(F.lit("raw/"), F.col(key).cast("string"), F.lit(".csv")).alias("path")

    expected = parts.select(
        F.col("p_name").alias("name"), path("p_partkey"), F.col("p_type").alias("description"),
        (F.col("p_size").cast("bigint") * 5000).alias("min_size_bytes"),
    )
    size = F.floor(F.col("o_totalprice") * (F.col("o_custkey") % 4000)).cast("bigint")
    present = orders.select(path("o_custkey"), size.alias("size_bytes"))
    return manifest.manifest_status(expected, present)


@query(f"SELECT file, path, status, note FROM {_STATUS}")
def manifest_status(spark, sf_dir):
    return _manifest(spark, sf_dir).select("file", "path", "status", "note")


@query(f"SELECT file, path, size, description FROM {_STATUS}")
def manifest_sizes(spark, sf_dir):
    return _manifest(spark, sf_dir).select("file", "path", "size", "description")


@query("SELECT coalesce(bool_and(status = 'OK'), true) AS all_ok, "
       f"count(*) FILTER (WHERE status <> 'OK') AS files_to_fix FROM {_STATUS}")
def manifest_verdict(spark, sf_dir):
    return manifest.manifest_verdict(_manifest(spark, sf_dir))


@query(f"SELECT file, note FROM {_STATUS} WHERE status <> 'OK'")
def manifest_actions(spark, sf_dir):
    return manifest.action_items(_manifest(spark, sf_dir))


@query(f"SELECT status, 2 * count(*) AS files FROM {_STATUS} GROUP BY status")
def manifest_log(spark, sf_dir):
    """The log after two runs."""
    path = scratch_path(spark, "ingestion_log")
    for _ in range(2):
        manifest.append_log(_manifest(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


_PUBLISHED = ["agg_genre", "agg_year", "agg_hit_vs_nohit"]
_PUBLISHED_KEYS = ["genre", "year", "is_chart_hit"]


@query(
    "SELECT 'agg_genre' AS table_name, count(DISTINCT genre) AS row_count, 'OK' AS status "
    "FROM master UNION ALL SELECT 'agg_year', count(DISTINCT year), 'OK' FROM master "
    "UNION ALL SELECT 'agg_hit_vs_nohit', "
    "count(DISTINCT is_chart_hit), 'OK' FROM master "
    "UNION ALL SELECT 'not_published', NULL, 'ERROR'"
)
def published_counts(spark, sf_dir):
    """Tables replaced as Parquet with views, then counted; one was never published."""
    # Stored with the columns that the three tables read: the others are not joined either.
    read = {*_PUBLISHED_KEYS, *aggregates.GENRE_MEANS, *aggregates.YEAR_MEANS, *aggregates.HIT_MEANS}
    rows = written(master(spark, sf_dir).select(sorted(read)), "master")
    folder = scratch_path(spark, "published")
    star.publish_all({
        "agg_genre": aggregates.agg_genre(rows),
        "agg_year": aggregates.agg_year(rows, 1900, 2100),
        "agg_hit_vs_nohit": aggregates.agg_hit(rows),
    }, folder)
    return quality.table_counts(spark, [*_PUBLISHED, "not_published"])


@query(
    " UNION ALL ".join(
        f"SELECT {version} AS version, '{name}' AS table_name, count(DISTINCT {key}) AS row_count, "
        f"CAST(sum(is_chart_hit) AS BIGINT) AS chart_hits FROM {table}"
        for version, table in ((1, "master_all"), (2, "master"))
        for name, key in (("agg_genre", "genre"), ("agg_hit_vs_nohit", "is_chart_hit")))
)
def publish_snapshot(spark, sf_dir):
    """Two tables published twice, each time together; both versions are read afterwards."""
    store = Snapshots(spark, scratch_path(spark, "snapshots"))
    for unique_keys in (False, True):
        # Not written: both tables read two columns of it, and entries repeat its rows.
        rows = master(spark, sf_dir, unique_keys=unique_keys)
        genres = aggregates.agg_genre(rows).select("genre", "chart_hits")
        flags = rows.groupBy("is_chart_hit").agg(F.sum("is_chart_hit").alias("chart_hits"))
        store.publish({"agg_genre": genres, "agg_hit_vs_nohit": flags})
    found = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("chart_hits").alias("chart_hits"))
        .withColumns({"version": F.lit(version), "table_name": F.lit(name)})
        for version in (1, 2) for name, df in store.read(version).items()
    ]
    return reduce(DataFrame.unionByName, found).select(
        "version", "table_name", "row_count", "chart_hits")


# Column steps --------------------------------------------------------------

_CAST_KEYS = "artist_name, track_name, track_id"


@query(
    f"SELECT {_CAST_KEYS}, TRY_CAST(popularity AS INTEGER) AS popularity, "
    "TRY_CAST(year AS INTEGER) AS year, "
    "CAST(TRY_CAST(danceability AS FLOAT) AS DOUBLE) AS danceability, "
    "TRY_CAST(duration_ms AS BIGINT) AS duration_ms, TRY_CAST(tempo AS DOUBLE) AS tempo "
    "FROM raw_tracks"
)
def cast_lenient(spark, sf_dir):
    typed = C.cast_columns(roles.raw_tracks(spark, sf_dir), {
        "popularity": "int", "year": "int", "danceability": "float", "duration_ms": "bigint",
        "tempo": "double", "not_there": "int",
    })
    return shown(C.select_existing(typed, [
        "artist_name", "track_name", "track_id", "popularity", "year", "danceability",
        "duration_ms", "tempo", "not_there",
    ]))


@query(
    "SELECT track_id, CAST(trunc(CAST(loudness AS DOUBLE)) AS INTEGER) AS loudness "
    "FROM raw_tracks"
)
def cast_truncating(spark, sf_dir):
    """Fractions cut instead of rejected."""
    slim = roles.raw_tracks(spark, sf_dir).select("track_id", "loudness")
    return C.cast_columns(slim, {"loudness": "int"}, truncate_decimals=True)


@query(
    'SELECT trim("artist(s)_name") AS artist_name, '
    'CAST(TRY_CAST("danceability_%" AS FLOAT) AS DOUBLE) / 100 AS danceability, '
    'CAST(TRY_CAST("valence_%" AS FLOAT) AS DOUBLE) / 100 AS valence, 1 AS is_chart_hit '
    "FROM raw_charts"
)
def percent_fractions(spark, sf_dir):
    named = C.rename(roles.raw_charts(spark, sf_dir), {"artist(s)_name": "artist_name"})
    scaled = C.percent_to_fraction(named, schemas.CHART_PERCENTAGES)
    flagged = C.with_flag(C.trim_columns(scaled, ["artist_name"]), "is_chart_hit")
    return flagged.select("artist_name", "danceability", "valence", "is_chart_hit")


@query(
    "SELECT track_id, trim(artist_name) AS artist_name, trim(lower(genre)) AS genre, "
    "trim(lower(artist_name)) AS join_artist FROM raw_tracks"
)
def text_cleanup(spark, sf_dir):
    slim = roles.raw_tracks(spark, sf_dir).select("track_id", "artist_name", "genre")
    keyed = C.normalize_key(slim, "artist_name", "join_artist")
    return C.normalize_text(C.trim_columns(keyed, ["artist_name"]), ["genre"])


@query(
    "SELECT album_id, CAST(d AS VARCHAR) AS release_date, CAST(month(d) AS INTEGER) AS "
    "release_month, CAST(year(d) AS INTEGER) AS release_year FROM (SELECT album_id, "
    "try_strptime(regexp_replace(release_date, ' UTC$', ''), '%Y-%m-%d %H:%M:%S') AS d "
    "FROM raw_albums)"
)
def release_dates(spark, sf_dir):
    slim = roles.raw_albums(spark, sf_dir).select("album_id", "release_date")
    return C.parse_release_date(slim).withColumn(
        "release_date", F.col("release_date").cast("string")
    )


@query(
    "SELECT id, coalesce(TRY_CAST(followers AS BIGINT), 0) AS followers, "
    + rounded("ln(1 + CAST(coalesce(TRY_CAST(followers AS BIGINT), 0) AS DOUBLE))", 6)
    + " AS followers_log, coalesce(genre_2, 'unknown') AS genre_2 FROM raw_artists"
)
def log_followers(spark, sf_dir):
    """Null fills, zero for unreadable numbers, and the log feature."""
    slim = roles.raw_artists(spark, sf_dir).select("id", "followers", "genre_2")
    filled = C.fill_nulls(C.coalesce_zero(slim, ["followers"]), {"genre_2": "unknown"})
    logged = C.with_log1p(filled, "followers", "followers_log")
    return logged.withColumn("followers_log", F.round("followers_log", 6))


# Filters -------------------------------------------------------------------

@query("SELECT id, name FROM raw_artists WHERE id IS NOT NULL AND name IS NOT NULL")
def require_fields(spark, sf_dir):
    return filters.require(roles.raw_artists(spark, sf_dir), ["id", "name"]).select("id", "name")


@query(
    "SELECT track_id, popularity, CAST(liveness AS DOUBLE) AS liveness FROM tracks WHERE popularity BETWEEN 0 AND 100 "
    "AND liveness BETWEEN 0 AND 1"
)
def range_filter(spark, sf_dir):
    kept = filters.in_range(tracks(spark, sf_dir), "popularity", 0, 100)
    kept = filters.in_range(kept, "liveness", 0.0, 1.0)
    return shown(kept.select("track_id", "popularity", "liveness"))


@query("SELECT track_id, duration_ms FROM tracks WHERE duration_ms >= 30000")
def lower_bound(spark, sf_dir):
    return filters.at_least(tracks(spark, sf_dir), "duration_ms", 30000).select(
        "track_id", "duration_ms"
    )


@query(
    "SELECT id, p AS artist_popularity FROM (SELECT id, TRY_CAST(artist_popularity AS INTEGER) "
    "AS p FROM raw_artists) WHERE p IS NULL OR p BETWEEN 0 AND 100"
)
def range_or_null(spark, sf_dir):
    typed = C.cast_columns(roles.raw_artists(spark, sf_dir), schemas.ARTIST_TYPES)
    return filters.in_range_or_null(typed, "artist_popularity", 0, 100).select(
        "id", "artist_popularity"
    )


@query("SELECT track_id, label FROM raw_albums WHERE label <> '5-LOW '")
def not_equal(spark, sf_dir):
    """A missing label fails as well."""
    slim = roles.raw_albums(spark, sf_dir).select("track_id", "label")
    return filters.differs(slim, "label", "5-LOW ")


@query("SELECT event_id, track_name, artist_name FROM plays WHERE track_name <> '' "
       "AND artist_name <> ''")
def text_present(spark, sf_dir):
    kept = filters.require_text(roles.plays(spark, sf_dir), ["track_name", "artist_name"])
    return kept.select("event_id", "track_name", "artist_name")


# Dedup and top-k -----------------------------------------------------------

@query("SELECT * FROM first_tracks")
def dedup_first(spark, sf_dir):
    """One raw row per track id."""
    raw = filters.require(roles.raw_tracks(spark, sf_dir), schemas.TRACK_REQUIRED)
    return dedup.dedup_any(raw, ["track_id"])


@query("SELECT * FROM artist_dim")
def dedup_best(spark, sf_dir):
    """The most popular row per artist name."""
    return joins.artist_dimension(artists(spark, sf_dir))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate "
       "FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate LIMIT 5000")
def head_rows(spark, sf_dir):
    """The first 5,000 rows of the scan in a stated order."""
    lines = roles.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    first = dedup.head_rows(lines, 5000, lines.columns)
    return first.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, row_number() OVER (ORDER BY "
       "o_orderkey) AS seq, o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) AS first "
       "FROM orders")
def file_order_rows(spark, sf_dir):
    """Rows numbered by their place in several files without an order column, and the first row of
    each customer there."""
    orders = roles.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("customer"), "o_orderkey")
    path = scratch_path(spark, "ordered")
    orders.repartitionByRange(6, "o_orderkey").sortWithinPartitions("o_orderkey").write.csv(path)
    scan = spark.read.schema("customer string, o_orderkey bigint").csv(path)
    placed = lake.with_file_order(scan)
    first = dedup.dedup_any(placed, ["customer"], ["file_order"]).select(
        "o_orderkey", F.lit(True).alias("first"))
    numbered = dedup.number_rows(placed, ["file_order"]).drop("file_order")
    return numbered.join(first, "o_orderkey", "left").select(
        "o_orderkey", "customer", "seq", F.coalesce("first", F.lit(False)).alias("first"))


# Cleaning plans ------------------------------------------------------------

@query(f"SELECT {widened(FLOATS)} FROM clean_tracks")
def clean_tracks(spark, sf_dir):
    return shown(cleaning.clean_tracks(roles.raw_tracks(spark, sf_dir)))


@query("SELECT * FROM clean_artists")
def clean_artists(spark, sf_dir):
    return artists(spark, sf_dir)


@query("SELECT * FROM clean_albums")
def clean_albums(spark, sf_dir):
    cleaned = albums(spark, sf_dir)
    return cleaned.withColumn("release_date", F.col("release_date").cast("string"))


@query(f"SELECT {widened(['tempo'])} FROM clean_charts")
def clean_charts(spark, sf_dir):
    return shown(charts(spark, sf_dir))


# Joins ---------------------------------------------------------------------

_TRACK_KEYS = "t.track_id, t.artist_name, t.track_name, t.duration_ms, t.key"
_ARTIST_COLUMNS = "a.artist_id, a.artist_popularity, a.followers, a.genre_0, a.genre_1, a.genre_2"


def _slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks(spark, sf_dir).select(
        "track_id", "artist_name", "track_name", "duration_ms", "key"
    )


def _artist_join(dim: str) -> str:
    return (f"SELECT {_TRACK_KEYS}, {_ARTIST_COLUMNS} FROM tracks t LEFT JOIN {dim} a "
            "ON lower(t.artist_name) = a.join_artist")


def _chart_join(dim: str) -> str:
    return (f"SELECT {_TRACK_KEYS}, c.streams, c.in_spotify_playlists, c.in_spotify_charts, "
            f"c.artist_count, c.is_chart_hit FROM tracks t LEFT JOIN {dim} c "
            "ON lower(t.track_name) = c.join_track AND lower(t.artist_name) = c.join_artist")


@query(_artist_join("artist_dim"))
def join_artists(spark, sf_dir):
    return joins.enrich_artists(_slim(spark, sf_dir), artists(spark, sf_dir)).drop("join_artist")


@query(_artist_join("artist_dim_all"))
def join_artists_all_spellings(spark, sf_dir):
    """Each spelling of an artist joins, so tracks repeat."""
    joined = joins.enrich_artists(
        _slim(spark, sf_dir), artists(spark, sf_dir), unique_keys=False
    )
    return joined.drop("join_artist")


@query(_artist_join("artist_dim"))
def join_artists_salted(spark, sf_dir):
    """The same join with its frequent artists spread over salts."""
    left = _slim(spark, sf_dir)
    keyed = joins.with_join_keys(left)
    hot = joins.hot_key_hashes(keyed, {"artist": ["join_artist"]}, share=0.01)["artist"]
    joined = joins.enrich_artists(left, artists(spark, sf_dir), hot=hot)
    return joined.drop("join_artist")


@query(
    f"SELECT {_TRACK_KEYS}, b.* EXCLUDE (track_id) FROM tracks t "
    "LEFT JOIN album_dim b ON t.track_id = b.track_id"
)
def join_albums(spark, sf_dir):
    return joins.enrich_albums(_slim(spark, sf_dir), albums(spark, sf_dir))


@query(_chart_join("chart_dim"))
def join_charts(spark, sf_dir):
    joined = joins.enrich_charts(_slim(spark, sf_dir), charts(spark, sf_dir))
    return joined.drop("join_track", "join_artist")


@query(_chart_join("chart_dim_all"))
def join_charts_all_entries(spark, sf_dir):
    joined = joins.enrich_charts(_slim(spark, sf_dir), charts(spark, sf_dir), unique_keys=False)
    return joined.drop("join_track", "join_artist")


def _master_columns(table: str) -> str:
    log = rounded("followers_log", 6)
    return f"SELECT {widened(FLOATS, f', {log} AS followers_log')} FROM {table}"


@query(_master_columns("master"))
def master_table(spark, sf_dir):
    return shown(master(spark, sf_dir))


@query(_master_columns("master"))
def master_table_salted(spark, sf_dir):
    return shown(master(spark, sf_dir, hot_share=0.01))


@query(_master_columns("master_all"))
def master_table_repeating(spark, sf_dir):
    # Chart entries repeat rows: what is shown is worked out before they join.
    return master(spark, sf_dir, unique_keys=False, view=shown)


# Aggregates ----------------------------------------------------------------

def _means(**places: int) -> str:
    """SQL for rounded means; the lists are written out here, apart from those of the library."""
    return ", ".join(f"{rounded(f'avg({c})', n)} AS avg_{c}" for c, n in places.items())


_GENRE_SQL = _means(popularity=2, danceability=3, energy=3, valence=3, acousticness=3,
                    speechiness=3, tempo=1, loudness=2)
_YEAR_SQL = _means(popularity=2, danceability=3, energy=3, valence=3, acousticness=3, tempo=1)
_LABEL_SQL = _means(popularity=2, album_popularity=2)
_HIT_SQL = _means(popularity=2, danceability=3, energy=3, valence=3, acousticness=3,
                  speechiness=3, instrumentalness=3, liveness=3, tempo=1, loudness=2,
                  duration_ms=0, followers_log=3, artist_popularity=2)
_ARTIST_SQL = _means(danceability=3, energy=3, valence=3)
_HITS = "CAST(sum(is_chart_hit) AS BIGINT) AS chart_hits"
_STREAMS = "CAST(sum(streams) AS BIGINT) AS total_streams"
_GENRES = (f"SELECT genre, count(*) AS track_count, {_GENRE_SQL}, {_HITS} "
           "FROM master GROUP BY genre")
_YEARS = (f"SELECT year, count(*) AS track_count, {_YEAR_SQL}, {_HITS} "
          "FROM master WHERE year BETWEEN 1996 AND 2000 GROUP BY year")
_FLAGS = (f"SELECT is_chart_hit, count(*) AS track_count, {_HIT_SQL} "
          "FROM master GROUP BY is_chart_hit")
_ARTIST_ALL = (
    "SELECT artist_name, count(*) AS track_count, "
    f"{rounded('avg(popularity)', 2)} AS avg_popularity, max(followers) AS followers, "
    f"{rounded('avg(artist_popularity)', 1)} AS artist_popularity, {_HITS}, {_STREAMS}, "
    f"{_ARTIST_SQL} FROM master GROUP BY artist_name"
)
_ARTIST_TOP = f"{_ARTIST_ALL} ORDER BY avg_popularity DESC NULLS LAST, artist_name LIMIT 50"


@query(_GENRES)
def agg_genre(spark, sf_dir):
    return aggregates.agg_genre(master(spark, sf_dir))


@query(_YEARS)
def agg_year(spark, sf_dir):
    return aggregates.agg_year(master(spark, sf_dir), 1996, 2000)


@query(
    f"SELECT label, count(*) AS track_count, {_LABEL_SQL}, {_HITS}, "
    f"{_STREAMS} FROM master WHERE label <> 'Independent' GROUP BY label "
    "ORDER BY avg_popularity DESC NULLS LAST, label LIMIT 3"
)
def agg_label(spark, sf_dir):
    return aggregates.agg_label(master(spark, sf_dir), k=3)


@query(_FLAGS)
def agg_hit_vs_nohit(spark, sf_dir):
    return aggregates.agg_hit(master(spark, sf_dir))


@query(_ARTIST_TOP)
def agg_artist(spark, sf_dir):
    return aggregates.agg_artist(master(spark, sf_dir))


def _master_part(columns: list[str], table: str = "master") -> str:
    log = rounded("followers_log", 6)
    return (f"SELECT {', '.join(columns)} FROM (SELECT "
            f"{widened(FLOATS, f', {log} AS followers_log')} FROM {table}) "
            "WHERE popularity IS NOT NULL")


@query(_master_part(schemas.MODEL_COLUMNS))
def master_ml(spark, sf_dir):
    return shown(aggregates.master_ml(master(spark, sf_dir)))


# Quality -------------------------------------------------------------------

@query(
    "SELECT step, rows_in, rows_out, rows_in - rows_out AS rows_removed FROM ("
    "SELECT 'tracks' AS step, (SELECT count(*) FROM raw_tracks) AS rows_in, "
    "(SELECT count(*) FROM clean_tracks) AS rows_out UNION ALL "
    "SELECT 'artists', (SELECT count(*) FROM raw_artists), (SELECT count(*) FROM clean_artists))"
)
def step_metrics(spark, sf_dir):
    """Rows in and out, observed while each dataset is written."""
    steps = {}
    for name, raw, clean in [
        ("tracks", roles.raw_tracks, cleaning.clean_tracks),
        ("artists", roles.raw_artists, cleaning.clean_artists),
    ]:
        source, seen = quality.observed(raw(spark, sf_dir), f"{name}_in")
        result, kept = quality.observed(clean(source), f"{name}_out")
        lake.write_layer(result, scratch_path(spark, f"clean_{name}"))
        steps[name] = (seen.get["rows"], kept.get["rows"])
    return quality.step_metrics(spark, steps)


@query(
    "SELECT count(*) AS rows, count(*) FILTER (WHERE artist_id IS NOT NULL) AS matched_artists, "
    "CAST(sum(is_chart_hit) AS BIGINT) AS chart_hits FROM master"
)
def join_metrics(spark, sf_dir):
    """Matches of the master joins, observed while the table is written."""
    built, seen = quality.observed(
        master(spark, sf_dir), "master", quality.join_conditions()
    )
    lake.write_layer(built, scratch_path(spark, "master"))
    found = seen.get
    return spark.createDataFrame(
        [(found["rows"], found["matched_artists"], found["chart_hits"])],
        "rows bigint, matched_artists bigint, chart_hits bigint",
    )


@query(
    "SELECT (SELECT count(*) FROM tracks) AS base_rows, count(*) AS joined_rows, "
    "count(*) <= (SELECT count(*) FROM tracks) * 1.05 AS within_limit FROM master_all"
)
def fanout_guard(spark, sf_dir):
    """The joined rows are counted by track: each track is joined once with how many matches it
    has, however many rows that makes."""
    return quality.fanout_report(
        tracks(spark, sf_dir), master(spark, sf_dir, unique_keys=False, counted=True),
        times=JOINED_ROWS,
    )


@query(
    "SELECT count(*) FILTER (WHERE whole AND n > 1) AS duplicate_keys, "
    "CAST(coalesce(sum(n) FILTER (WHERE whole AND n > 1), 0) AS BIGINT) AS duplicate_rows, "
    "CAST(coalesce(sum(n) FILTER (WHERE NOT whole), 0) AS BIGINT) AS null_key_rows FROM ("
    "SELECT l_orderkey, rf, l_orderkey IS NOT NULL AND rf IS NOT NULL AS whole, count(*) AS n "
    "FROM (SELECT l_orderkey, nullif(l_returnflag, 'N') AS rf FROM lineitem) GROUP BY ALL)"
)
def key_check(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem")
    keyed = lines.select("l_orderkey", F.expr("nullif(l_returnflag, 'N')").alias("rf"))
    return quality.check_keys(keyed, ["l_orderkey", "rf"])


# Star schema and reports ---------------------------------------------------

@query(_master_part(schemas.FACT_COLUMNS))
def fact_popularity(spark, sf_dir):
    return shown(star.fact_popularity(aggregates.master_ml(master(spark, sf_dir))))


@query(
    "SELECT * EXCLUDE (_rank) FROM (SELECT track_id, track_name, artist_name, genre, year, "
    "duration_ms, is_chart_hit, streams, row_number() OVER (PARTITION BY track_id ORDER BY "
    "track_name, artist_name, genre, year, duration_ms, is_chart_hit, streams) AS _rank "
    "FROM master WHERE popularity IS NOT NULL) WHERE _rank = 1"
)
def dim_tracks(spark, sf_dir):
    return star.dim_tracks(aggregates.master_ml(master(spark, sf_dir)))


@query(f"SELECT * FROM ({_ARTIST_ALL})")
def dim_artists(spark, sf_dir):
    """The published artist table holds every artist."""
    return lake.publish(
        aggregates.artist_profiles(master(spark, sf_dir)), "dim_artists",
        scratch_path(spark, "dim_artists"),
    )


@query("SELECT count(*) AS fact_rows, CAST(0 AS BIGINT) AS without_artist FROM clean_master "
       "WHERE popularity IS NOT NULL")
def dimension_complete(spark, sf_dir):
    """Published fact rows of a whole run, and those whose artist has no row in its dimension."""
    tables = _full_run(spark, sf_dir).tables
    known = tables["dim_artists"].select("artist_name", F.lit(1).alias("known"))
    joined = tables["fact_popularity"].select("artist_name").join(known, "artist_name", "left")
    return joined.agg(F.count(F.lit(1)).alias("fact_rows"),
                      F.count_if(F.col("known").isNull()).alias("without_artist"))


@query(f"SELECT genre, avg_popularity, track_count, chart_hits FROM ({_GENRES}) "
       "ORDER BY avg_popularity DESC, genre LIMIT 5")
def report_top_genres(spark, sf_dir):
    return star.sql_top_genres(aggregates.agg_genre(master(spark, sf_dir)))


@query(f"SELECT year, avg_popularity, track_count FROM ({_YEARS}) WHERE year >= 1998")
def report_recent_trend(spark, sf_dir):
    return star.sql_recent_trend(aggregates.agg_year(master(spark, sf_dir), 1996, 2000), 1998)


@query(f"SELECT is_chart_hit, track_count, avg_popularity, avg_danceability, avg_energy, "
       f"avg_valence FROM ({_FLAGS})")
def report_hit_compare(spark, sf_dir):
    return star.sql_hit_compare(aggregates.agg_hit(master(spark, sf_dir)))


# The whole run ------------------------------------------------------------

def _raw_lake(spark: SparkSession, sf_dir: str) -> lake.LakePaths:
    """A lake whose raw layer has the four files."""
    paths = lake.LakePaths(scratch_path(spark, "lake"))
    for name, raw in [("tracks", roles.raw_tracks), ("artists", roles.raw_artists),
                      ("albums", roles.raw_albums), ("charts", roles.raw_charts)]:
        lake.export_csv(raw(spark, sf_dir), paths.raw(flow.RAW_FILES[name]))
    return paths


def _full_run(
    spark: SparkSession, sf_dir: str, unique_keys: bool = True,
    forest: ForestSettings | None = None,
) -> flow.RunReport:
    """Raw CSV files derived from the tables, then everything up to the published tables."""
    paths = _raw_lake(spark, sf_dir)
    return flow.run_flow(
        spark, paths, paths.curated("published"), unique_keys=unique_keys, forest=forest,
        settings=flow.CurateSettings(years=(1990, 2010)),
    )


def _step(name: str, before: str, after: str) -> str:
    return (f"SELECT '{name}' AS step, (SELECT count(*) FROM {before}) AS rows_in, "
            f"(SELECT count(*) FROM {after}) AS rows_out")


@query(
    "SELECT *, rows_in - rows_out AS rows_removed FROM ("
    + " UNION ALL ".join([
        *[_step(f"clean_{n}", f"raw_{n}", f"clean_{n}")
          for n in ["tracks", "charts", "artists", "albums"]],
        _step("build_master", "clean_tracks", "clean_master"),
    ]) + ")"
)
def full_run_steps(spark, sf_dir):
    """Rows in, out and removed per step of a run from raw files."""
    return _full_run(spark, sf_dir).steps


@query(_master_part(schemas.FACT_COLUMNS, "clean_master"))
def full_run_fact(spark, sf_dir):
    """The published fact table of a run from raw files."""
    return shown(_full_run(spark, sf_dir).tables["fact_popularity"])


_FACT_KEYS = "(SELECT count(*) AS n FROM clean_master_all GROUP BY track_id)"


def _unique(name: str, rows: str) -> str:
    return f"SELECT '{name}', 0, 0, 0, ({rows})"


@query(
    "SELECT 'fact_popularity' AS table_name, count(*) FILTER (WHERE n > 1) AS duplicate_keys, "
    "CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows, "
    "CAST(0 AS BIGINT) AS null_key_rows, CAST(sum(n) AS BIGINT) AS row_count "
    f"FROM {_FACT_KEYS} UNION ALL " + " UNION ALL ".join([
        _unique("dim_tracks", "SELECT count(DISTINCT track_id) FROM clean_master_all"),
        _unique("dim_artists", "SELECT count(DISTINCT artist_name) FROM clean_master_all"),
        _unique("agg_genre", "SELECT count(DISTINCT genre) FROM clean_master_all"),
        _unique("agg_year", "SELECT count(DISTINCT year) FROM clean_master_all "
                            "WHERE year BETWEEN 1990 AND 2010"),
        _unique("agg_label", "SELECT least(count(DISTINCT label), 30) FROM clean_master_all "
                             "WHERE label <> 'Independent'"),
        _unique("agg_hit_vs_nohit", "SELECT count(DISTINCT is_chart_hit) FROM clean_master_all"),
    ])
)
def full_run_keys(spark, sf_dir):
    """Keys and rows of the published tables when every spelling joins: the fact repeats tracks."""
    tables = _full_run(spark, sf_dir, unique_keys=False).tables
    return _keys_and_rows(tables)


def _keys_and_rows(tables: dict[str, DataFrame]) -> DataFrame:
    checks = quality.stack_tagged(flow.key_report(tables), "table_name")
    rows = {name: df.agg(F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()}
    return checks.join(quality.stack_tagged(rows, "table_name"), "table_name")


_MODELS = {P.FULL: P.FULL_FEATURES, P.AUDIO: P.AUDIO_FEATURES}


@query(" UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{model}' AS model_name, '{entry}' AS entry, true AS sound"
    for model, features in _MODELS.items()
    for table, entries in (("ml_metrics", ["RMSE", "MAE", "R2"]),
                           ("ml_feature_importance", features.names()))
    for entry in entries))
def full_run_models(spark, sf_dir):
    """The published model tables of a run, entry by entry: each metric and each feature of both
    models once. Errors are positive, the mean one is not above the root mean square one, R2 is
    below one; weights are shares that sum to one, ranked from the largest."""
    tables = _full_run(spark, sf_dir, forest=ForestSettings()).tables
    value, model = F.col("value"), Window.partitionBy("model_name")

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, value)).over(model)

    right = (of("MAE") > 0) & (of("MAE") <= of("RMSE")) & (of("R2") < 1)
    metrics = tables["ml_metrics"].select(
        F.lit("ml_metrics").alias("table_name"), "model_name", F.col("metric").alias("entry"),
        right.alias("sound"))
    weight = F.col("importance")
    share = weight.between(0, 1) & (F.abs(F.sum(weight).over(model) - 1) < 1e-6)
    ranked = F.rank().over(model.orderBy(F.desc("importance"))) <= F.col("rank")
    weights = tables["ml_feature_importance"].select(
        F.lit("ml_feature_importance").alias("table_name"), "model_name",
        F.col("feature").alias("entry"), (share & ranked).alias("sound"))
    return metrics.unionByName(weights)


@query(
    "SELECT *, rows_in - rows_out AS rows_removed, step IN ('clean_tracks', 'clean_charts') "
    "AS reused, CAST(2 AS BIGINT) AS checks, true AS raw_ok FROM ("
    + " UNION ALL ".join([
        *[_step(f"clean_{n}", f"raw_{n}", f"clean_{n}")
          for n in ["tracks", "charts", "artists", "albums"]],
        _step("build_master", "clean_tracks", "clean_master"),
    ]) + ")"
)
def full_run_resumed(spark, sf_dir):
    """A run that stops after its second step and is resumed: the first two steps are not done
    again, and the raw files were checked at the start of either run."""
    paths = _raw_lake(spark, sf_dir)
    with suppress(StoppedRun):
        flow.run_flow(spark, paths, paths.curated("published"), until="clean_charts")
    report = flow.run_flow(spark, paths, paths.curated("published"), resume=True)
    checks = spark.read.parquet(paths.raw("ingestion_log")).agg(
        F.count_distinct("run_id").alias("checks"))
    verdict = manifest.manifest_verdict(report.raw).select(F.col("all_ok").alias("raw_ok"))
    steps = report.steps.withColumn("reused", F.col("step").isin(report.reused))
    return steps.join(F.broadcast(checks)).join(F.broadcast(verdict))


@query("SELECT (SELECT count(*) FROM tracks) AS base_rows, count(*) AS forecast_rows, "
       "count(*) <= (SELECT count(*) FROM tracks) * 1.05 AS within_limit FROM master_all")
def fanout_forecast(spark, sf_dir):
    """The rows of the master table in which every spelling joins, foretold without joining."""
    return master_forecast(
        tracks(spark, sf_dir), artists(spark, sf_dir), charts(spark, sf_dir), unique_keys=False)


@query(
    "SELECT 'size ' || s.n AS file, CASE WHEN p.bytes IS NULL THEN 'MISSING' "
    "WHEN p.bytes < 40 * s.n THEN 'WARNING — file smaller than expected' ELSE 'OK' END AS status, "
    f"CASE WHEN p.bytes IS NULL THEN '—' ELSE {_SIZE.format('p.bytes')} END AS size "
    "FROM (SELECT DISTINCT p_size + 3 AS n FROM part) s LEFT JOIN (SELECT p_size, "
    "CAST(sum(strlen(p_name) + 1) AS BIGINT) AS bytes FROM part GROUP BY p_size) p ON p.p_size = s.n"
)
def manifest_files(spark, sf_dir):
    """The check of a raw layer against files that are there: a folder of text for every size of a
    part, and expectations of which a few are not met."""
    parts = roles.table(spark, sf_dir, "part")
    root = scratch_path(spark, "raw-check")
    lines = parts.select(F.col("p_name").alias("value"), F.col("p_size").alias("size"))
    lines.repartition("size").write.partitionBy("size").text(f"{root}/raw")
    size = F.col("p_size") + 3
    expected = parts.select(
        F.concat(F.lit("size "), size.cast("string")).alias("name"),
        F.concat(F.lit("raw/size="), size.cast("string")).alias("path"),
        F.lit("Parts of one size").alias("description"),
        (size * 40).cast("bigint").alias("min_size_bytes")).distinct()
    return manifest.check_manifest(spark, expected, root, "raw").select("file", "status", "size")
