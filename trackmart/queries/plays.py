"""Queries over play events: records, batches, live statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.functions import columns as C
from trackmart.operators import frequent
from trackmart.queries import roles
from trackmart.queries.catalogue import query
from trackmart.queries.roles import rounded
from trackmart.session import scratch_path, written
from trackmart.sources import lake
from trackmart.sources.commits import PartTable
from trackmart.streaming import batches, events, live, metrics, stateful

BATCH_SIZE = 100

_NUMBERED = (
    "(SELECT *, (seq - 1) // 100 + 1 AS batch FROM (SELECT *, "
    'row_number() OVER (ORDER BY "timestamp") AS seq FROM plays))'
)
_NAMED = (
    "(SELECT batch, seq, coalesce(genre, 'unknown') AS genre, play_duration_ms, "
    "coalesce(track_name, 'Unknown') || ' — ' || coalesce(artist_name, 'Unknown') AS track "
    f"FROM {_NUMBERED})"
)


def _ranked(column: str, extra: str = "") -> str:
    return (
        f"(SELECT *, row_number() OVER (PARTITION BY batch ORDER BY plays DESC, first_seq) AS rank "
        f"FROM (SELECT batch, {column}, count(*) AS plays, min(seq) AS first_seq{extra} "
        f"FROM {_NAMED} GROUP BY batch, {column}))"
    )


_TOP_GENRES = (
    "(SELECT batch, CAST(rank AS INTEGER) AS rank, genre, plays, avg_seconds FROM "
    + _ranked("genre", f", {rounded('avg(play_duration_ms) / 1000', 1)} AS avg_seconds")
    + " WHERE rank <= 5)"
)
_TOP_TRACKS = (
    f"(SELECT batch, CAST(rank AS INTEGER) AS rank, track, plays FROM {_ranked('track')} "
    "WHERE rank <= 5)"
)
_SUMMARY = (
    "(SELECT s.batch AS batch_number, s.n AS batch_size, t.track AS top_track_1, "
    "t.plays AS top_track_1_plays, g.genre AS top_genre_1, g.plays AS top_genre_1_plays, "
    "coalesce(h.genre, '') AS top_genre_2, coalesce(h.plays, 0) AS top_genre_2_plays "
    f"FROM (SELECT batch, count(*) AS n FROM {_NUMBERED} GROUP BY batch) s "
    f"JOIN {_TOP_TRACKS} t ON s.batch = t.batch AND t.rank = 1 "
    f"JOIN {_TOP_GENRES} g ON s.batch = g.batch AND g.rank = 1 "
    f"LEFT JOIN {_TOP_GENRES} h ON s.batch = h.batch AND h.rank = 2)"
)
_GENRE_TOTALS = "SELECT coalesce(genre, 'unknown') AS genre, count(*) AS plays FROM plays GROUP BY 1"


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.assign_batches(roles.plays(spark, sf_dir), ["timestamp"], BATCH_SIZE)


# Records -------------------------------------------------------------------

# Every fifth event is an object without fields, every seventh one of NULLs; of the others every
# second writes its whole number with a fraction, every third with an exponent.
_VARIED = (
    "(SELECT CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN NULL ELSE event_id END AS event_id, "
    "CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN NULL ELSE track_id END AS track_id, "
    "CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN NULL ELSE genre END AS genre, "
    "CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN NULL WHEN n % 2 <> 0 AND n % 3 = 0 THEN 120000 "
    "ELSE play_duration_ms END AS play_duration_ms "
    "FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM plays) "
    "WHERE genre IS NULL OR genre NOT IN ('view', 'click'))"
)


def _varied_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): events as JSON in all these forms, with blank and broken lines among them."""
    number = F.col("event_id").cast("bigint")
    text = F.to_json(F.struct("*"))
    whole = F.concat(F.lit('"play_duration_ms":'), F.col("play_duration_ms").cast("string"))
    line = (
        F.when(F.col("genre") == "view", F.lit(""))
        .when(F.col("genre") == "click", F.concat(F.lit("bad "), text))
        .when(number % 5 == 0, F.lit("{}"))
        .when(number % 7 == 0, F.lit('{"event_id":null,"genre":null}'))
        .when(number % 2 == 0, F.replace(text, whole, F.concat(whole, F.lit(".0"))))
        .when(number % 3 == 0, F.replace(text, whole, F.lit('"play_duration_ms":1.2e5')))
        .otherwise(text)
    )
    return roles.plays(spark, sf_dir).select(line.alias("value"))


@query(f"SELECT * FROM {_VARIED}")
def event_scan(spark, sf_dir):
    """JSON lines of all forms from files."""
    path = scratch_path(spark, "event-lines")
    _varied_lines(spark, sf_dir).write.text(path)
    return lake.read_events(spark, path).select(
        "event_id", "track_id", "genre", "play_duration_ms"
    )


@query(f"SELECT * FROM {_VARIED}")
def event_values(spark, sf_dir):
    """The same lines as the values of messages."""
    return lake.from_messages(_varied_lines(spark, sf_dir)).select(
        "event_id", "track_id", "genre", "play_duration_ms"
    )


@query("SELECT event_id, \"timestamp\", track_id, track_name, artist_name, genre, popularity, "
       "duration_ms, play_duration_ms FROM plays")
def event_files(spark, sf_dir):
    """Events written as JSON lines and read back."""
    path = scratch_path(spark, "events")
    lake.write_events(roles.plays(spark, sf_dir), path)
    return lake.read_events(spark, path).drop("danceability", "energy", "valence")


@query("SELECT track_id AS key, event_id, genre, play_duration_ms FROM plays")
def event_messages(spark, sf_dir):
    """Keyed messages, encoded and decoded."""
    messages = lake.to_messages(roles.plays(spark, sf_dir))
    return lake.from_messages(messages).select(
        F.col("track_id").alias("key"), "event_id", "genre", "play_duration_ms"
    )


@query(
    "SELECT event_id, coalesce(CAST(trunc(TRY_CAST(x AS DOUBLE)) AS INTEGER), -1) AS as_int, "
    "coalesce(TRY_CAST(x AS DOUBLE), -1.0) AS as_float FROM (SELECT event_id, "
    "CASE WHEN event_type = 'error' THEN 'abc' WHEN event_type = 'view' THEN '' "
    "ELSE CAST(value AS VARCHAR) END AS x FROM events)"
)
def safe_conversions(spark, sf_dir):
    text = F.expr(
        "case when event_type = 'error' then 'abc' when event_type = 'view' then '' "
        "else cast(value as string) end"
    )
    return roles.table(spark, sf_dir, "events").select(
        "event_id", C.safe_int(text, -1).alias("as_int"), C.safe_float(text, -1.0).alias("as_float")
    )


@query(
    "SELECT md5(track_id || '-' || key) AS event_id, track_id, trim(track_name) AS track_name, "
    "trim(lower(genre)) AS genre, coalesce(TRY_CAST(popularity AS INTEGER), 0) AS popularity, "
    "CAST(danceability AS DOUBLE) AS danceability, CAST(duration_ms AS BIGINT) AS duration_ms, "
    "least(greatest(CAST(key AS BIGINT) * 20000, least(30000, CAST(duration_ms AS BIGINT))), "
    "CAST(duration_ms AS BIGINT)) AS play_duration_ms FROM raw_tracks"
)
def event_records(spark, sf_dir):
    """Track rows as play events; the listened time comes from a column."""
    raw = C.trim_columns(roles.raw_tracks(spark, sf_dir), ["track_name"])
    played = C.normalize_text(raw, ["genre"]).withColumns({
        "play_duration_ms": (F.col("key").cast("bigint") * 20000).cast("string"),
        "row_name": F.concat_ws("-", "track_id", "key"),
    })
    return events.to_events(played, "row_name").select(
        "event_id", "track_id", "track_name", "genre", "popularity", "danceability",
        "duration_ms", "play_duration_ms",
    )


@query(
    "SELECT count(*) AS events, count(*) FILTER (WHERE duration_ms IS NOT NULL) AS in_bounds "
    "FROM raw_tracks"
)
def drawn_durations(spark, sf_dir):
    """Listened time drawn from the row itself stays within its bounds."""
    raw = roles.raw_tracks(spark, sf_dir).withColumn(
        "row_name", F.concat_ws("-", "track_id", "key", "duration_ms")
    )
    made = events.to_events(raw, "row_name")
    inside = F.col("play_duration_ms").between(
        F.least(F.lit(30000), F.col("duration_ms")), F.col("duration_ms")
    )
    return made.agg(F.count(F.lit(1)).alias("events"), F.count_if(inside).alias("in_bounds"))


@query(
    "SELECT event_id, coalesce(genre, 'unknown') AS genre, coalesce(track_name, 'Unknown') || "
    "' — ' || coalesce(artist_name, 'Unknown') AS track FROM plays"
)
def display_keys(spark, sf_dir):
    """Defaults for missing names and the composed display key."""
    named = events.with_display_key(events.event_defaults(roles.plays(spark, sf_dir)))
    return named.select("event_id", "genre", "track")


@query(
    "SELECT event_id, track_name, artist_name FROM (SELECT * FROM plays ORDER BY \"timestamp\" "
    "LIMIT 5000) WHERE track_name <> '' AND artist_name <> ''"
)
def first_named_plays(spark, sf_dir):
    """The cap on the scan comes before the filter on names."""
    kept = events.first_tracks(roles.plays(spark, sf_dir), ["timestamp"], 5000)
    return kept.select("event_id", "track_name", "artist_name")


# Batches -------------------------------------------------------------------

@query(f"SELECT event_id, seq, batch FROM {_NUMBERED}")
def assigned_batches(spark, sf_dir):
    return batched(spark, sf_dir).select("event_id", "seq", "batch")


@query(f"SELECT * FROM {_TOP_TRACKS}")
def top_tracks(spark, sf_dir):
    return batches.top_tracks(batched(spark, sf_dir))


@query(f"SELECT * FROM {_TOP_GENRES}")
def top_genres(spark, sf_dir):
    return batches.top_genres(batched(spark, sf_dir))


@query(
    f"SELECT batch, genre, count(*) AS plays, {rounded('avg(play_duration_ms)', 3)} AS "
    f"avg_duration_ms FROM {_NAMED} GROUP BY batch, genre"
)
def genre_plays(spark, sf_dir):
    stats = batches.genre_plays(batched(spark, sf_dir)).drop("first_seq")
    return stats.withColumn("avg_duration_ms", F.round("avg_duration_ms", 3))


@query(f"SELECT batch, count(*) AS batch_size FROM {_NUMBERED} GROUP BY batch")
def batch_sizes(spark, sf_dir):
    return batches.batch_sizes(batched(spark, sf_dir))


@query(f"SELECT * FROM {_SUMMARY}")
def batch_summary(spark, sf_dir):
    return batches.batch_summary(batched(spark, sf_dir))


@query(f"SELECT count(DISTINCT batch) AS batches, count(*) AS events FROM {_NUMBERED}")
def stream_totals(spark, sf_dir):
    return batches.stream_totals(batches.batch_summary(batched(spark, sf_dir)))


@query(
    "SELECT genre, CAST(sum(plays) AS BIGINT) AS plays_undercounted "
    f"FROM {_TOP_GENRES} GROUP BY genre ORDER BY 2 DESC, min((batch, rank)) LIMIT 10"
)
def genre_totals_topk(spark, sf_dir):
    return batches.genre_totals_topk(batches.top_genres(batched(spark, sf_dir)))


@query(_GENRE_TOTALS)
def genre_totals(spark, sf_dir):
    return batches.genre_totals(roles.plays(spark, sf_dir))


# Live ----------------------------------------------------------------------

def _files(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query(f"SELECT * FROM {_SUMMARY}")
def live_batch_summary(spark, sf_dir):
    """The batch summary kept by a streaming query over numbered event files."""
    files = _files(spark)
    source, out = scratch_path(spark, "numbered-events"), scratch_path(spark, "summaries")
    live.write_event_files(batched(spark, sf_dir), source, files)
    stream = live.stream_events(spark, source, max(files // 4, 1), live.NUMBERED_EVENT)
    live.start_batch_summary(stream, out, scratch_path(spark, "state")).awaitTermination()
    return live.read_summaries(spark, out).drop("timestamp")


@query(_GENRE_TOTALS)
def live_genre_totals(spark, sf_dir):
    """Running plays per genre kept by a stateful streaming query."""
    files = _files(spark)
    source, out = scratch_path(spark, "event-files"), scratch_path(spark, "totals")
    roles.plays(spark, sf_dir).repartition(files, "event_id").write.json(source)
    stream = live.stream_events(spark, source, max(files // 4, 1))
    for _ in range(2):  # a second run from the start takes over
        live.start_genre_totals(stream, out, scratch_path(spark, "state")).awaitTermination()
    return live.latest_totals(spark, out)


def _write_fifths(spark: SparkSession, sf_dir: str, source: str) -> int:
    """Plain events as five sets of files by time, one after another, as a stream takes files in
    the order of their times; gives the files of a set."""
    rows = written(batched(spark, sf_dir), "events")
    share, files = rows.count() / 5, max(_files(spark) // 4, 1)
    for n in range(5):
        fifth = rows.filter(F.floor((F.col("seq") - 1) / F.lit(share)) == n)
        spread = fifth.repartitionByRange(files, "seq").drop("seq", "batch")
        spread.write.mode("append").json(source)
    return files


@query(f"SELECT * FROM {_SUMMARY}")
def live_counted_batches(spark, sf_dir):
    """Batches of 100 counted on a stream of plain events, whose micro-batches end anywhere."""
    source, out = scratch_path(spark, "plain-events"), scratch_path(spark, "counted")
    files = _write_fifths(spark, sf_dir, source)
    stream = live.stream_events(spark, source, files)
    query_ = live.start_counted_batches(stream, out, scratch_path(spark, "state"), ["timestamp"],
                                        BATCH_SIZE)
    query_.awaitTermination()
    return live.counted_summary(spark, out)


@query(f"SELECT * FROM {_SUMMARY}")
def live_state_batches(spark, sf_dir):
    """The same batches, their count and the open one kept in the state store; a second run from
    the checkpoint finds nothing new."""
    source, out = scratch_path(spark, "plain-events"), scratch_path(spark, "closed")
    checkpoint = scratch_path(spark, "state")
    files = _write_fifths(spark, sf_dir, source)
    for _ in range(2):
        stream = live.stream_events(spark, source, files)
        query_ = stateful.start_state_batches(
            stream, out, checkpoint, F.col("timestamp"), BATCH_SIZE)
        query_.awaitTermination()
    return stateful.state_summary(spark, out, checkpoint, BATCH_SIZE).drop("lane")


@query("SELECT 'read_events' AS step, count(*) FILTER (WHERE genre IS NULL OR genre <> 'view') "
       "AS rows_in, count(*) FILTER (WHERE genre IS NULL OR genre NOT IN ('view', 'click')) AS "
       "rows_out, count(*) FILTER (WHERE genre = 'click') AS rows_removed, "
       f"(SELECT count(*) FROM {_VARIED} WHERE genre IS NULL) AS without_genre FROM plays")
def live_step_metrics(spark, sf_dir):
    """Lines in, dropped and counted by a streaming query, observed in each micro-batch."""
    source, out = scratch_path(spark, "event-lines"), scratch_path(spark, "totals")
    files = _files(spark)
    _varied_lines(spark, sf_dir).repartition(files).write.text(source)
    listener = metrics.StepListener()
    spark.streams.addListener(listener)
    try:
        stream = metrics.watched_events(spark, source, max(files // 4, 1))
        query_ = live.start_genre_totals(stream, out, scratch_path(spark, "state"))
        query_.awaitTermination()
        counts = listener.counts(query_)
    finally:
        spark.streams.removeListener(listener)
    steps = metrics.stream_steps(spark, counts)
    return steps.withColumn("without_genre", F.lit(counts["events"]["without_genre"]))


@query(
    "SELECT kind, k, events, true AS bounded, true AS within, true AS none_missed FROM ("
    "SELECT 'genre' AS kind, CAST(2 AS INTEGER) AS k, count(*) AS events FROM plays "
    "UNION ALL SELECT 'track', 40, count(*) FROM plays)"
)
def genre_totals_bounds(spark, sf_dir):
    """Frequent genres and tracks from sketches of each batch, merged as parts of a table: their
    bounds against the exact counts, and no count beyond the error left out."""
    counts = written(batches.batch_counts(batched(spark, sf_dir)), "counts")
    found = []
    for kind, k in (("genre", 2), ("track", 40)):
        own = counts.filter(F.col("kind") == kind)
        table = PartTable(spark, scratch_path(spark, "sketch"), frequent.merger(k), fan_in=2)
        for part in range(5):
            some = own.filter(F.col("batch") % 5 == part).groupBy("name").agg(
                F.sum("plays").alias("plays"))
            table.append(frequent.sketch_of(some, k), part)
        sketch = written(table.read(), "merged")
        exact = own.groupBy("name").agg(F.sum("plays").alias("plays"))
        error = sketch.filter("name is null").agg(F.max("error")).scalar()
        joined = exact.join(frequent.bounds(sketch), "name", "left")
        plays, known = F.col("plays"), F.col("lower").isNotNull()
        found.append(joined.agg(
            F.lit(kind).alias("kind"), F.lit(k).alias("k"), F.sum("plays").alias("events"),
            ((F.count_if(known) <= k) & (F.max(error) * (k + 1) <= F.sum("plays")))
            .alias("bounded"),
            F.bool_and(~known | plays.between(F.col("lower"), F.col("upper"))).alias("within"),
            F.bool_and(known | (plays <= error)).alias("none_missed")))
    return found[0].unionByName(found[1])
