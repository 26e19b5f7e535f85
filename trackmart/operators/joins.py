"""Left joins of the track fact with its dimensions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.functions.columns import normalize_key, select_existing
from trackmart.operators.dedup import dedup_best
from trackmart.operators.filters import require

SALTS_PER_TASK = 8
# Rows of a repeating key are gathered in arrays of at most so many.
GATHERED = 1024


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def salts_for(tasks: int, share: float = 1.0) -> int:
    """Salts that spread a key with ``share`` of the rows evenly over the tasks of a shuffle.

    Salts are dealt to the tasks by a hash, so a task gets several of them. By
    default the key may hold all rows; a key with fewer then has small parts,
    which AQE merges.
    """
    return max(2, math.ceil(SALTS_PER_TASK * share * tasks))


def hot_key_hashes(
    df: DataFrame, key_sets: Mapping[str, Sequence[str]], share: float = 0.02
) -> dict[str, list[int]]:
    """Hashes of the keys that may hold more than ``share`` of the rows, per key set.

    One pass without a shuffle of the rows. At most ``1 / share`` hashes come
    back for each set, and none of the hot ones is missed; a hash too many only
    salts a key that did not need it.
    """
    hashed = df.select(*[key_hash(keys).alias(name) for name, keys in key_sets.items()])
    row = hashed.freqItems(list(key_sets), support=share).first()
    return {name: list(row[f"{name}_freqItems"] or []) for name in key_sets}


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: Sequence[int] = (),
    spread_by: Sequence[str] = ("track_id",),
    salts: int | None = None,
) -> DataFrame:
    """Left equi-join; rows of the ``hot`` keys spread over ``salts`` tasks.

    ``spread_by`` names left columns that tell the rows of one key apart.

    A right side that is small by its statistics or by its measured shuffle size
    is broadcast by Spark itself. For the others each right row with a hot key is
    repeated once per salt, so every left row still meets each match exactly once.
    """
    if not hot:
        return left.join(right, on=list(keys), how="left")
    if salts is None:
        salts = salts_for(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    is_hot = key_hash(keys).isin(list(hot))
    # The extra literal keeps the salt apart from a hash of the join keys.
    left_salt = F.when(is_hot, F.pmod(F.xxhash64(*spread_by, F.lit(1)), F.lit(salts)))
    right_salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_left = left.withColumn(
        "_salt", F.coalesce(left_salt, F.lit(0)).cast("int")
    )
    salted_right = right.withColumn(
        "_salt", F.explode(F.coalesce(right_salts, F.array(F.lit(0))))
    )
    return salted_left.join(salted_right, on=[*keys, "_salt"], how="left").drop("_salt")


def gathered(right: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The rows of each key as arrays of structs, of at most ``GATHERED`` rows each."""
    columns = [c for c in right.columns if c not in keys]
    # Dealt by the hash as well, so that a join on the keys moves the arrays once more: only a side
    # that it moved itself lets it split the other one where that is skewed.
    dealt = right.withColumn("_hash", key_hash(keys))
    place = F.row_number().over(Window.partitionBy(*keys, "_hash").orderBy(*columns))
    parts = dealt.withColumn("_part", F.floor((place - 1) / GATHERED))
    arrays = parts.groupBy(*keys, "_hash", "_part").agg(
        F.collect_list(F.struct(*columns)).alias(name))
    return arrays.select(*keys, name)


def repeating_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: Sequence[int] = (),
    unmatched: Mapping[str, object] | None = None,
) -> DataFrame:
    """``left_join`` with a right side that repeats keys, so that its rows repeat those of ``left``.

    A left row is looked up, sorted and matched once for an array of right rows,
    not for each of them, and what it holds is read once for all rows that it
    repeats in. ``unmatched`` has the values of a row without a match, by default NULL.
    """
    joined = left_join(left, gathered(right, keys, "_rows"), keys, hot)
    if unmatched is not None:
        kinds = dict(right.dtypes)
        values = [F.lit(unmatched.get(c)).cast(kinds[c]).alias(c)
                  for c in right.columns if c not in keys]
        joined = joined.withColumn("_rows", F.coalesce("_rows", F.array(F.struct(*values))))
    kept = [F.col(f"`{c}`") for c in joined.columns if c != "_rows"]
    return joined.select(*kept, F.inline_outer("_rows"))


def match_counts(right: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row per key with how many rows a left row of that key would meet."""
    return right.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def artist_dimension(artists: DataFrame, unique_keys: bool = True) -> DataFrame:
    """The most popular row per artist name, keyed by ``join_artist``.

    With ``unique_keys`` names that differ only in case or spaces are one artist;
    without it each spelling keeps its row and the join repeats the track.
    """
    slim = require(select_existing(artists, ["artist_name", *schemas.ARTIST_ATTRIBUTES]),
                   ["artist_name"])
    keyed = normalize_key(slim, "artist_name", "join_artist")
    key = "join_artist" if unique_keys else "artist_name"
    best = dedup_best(keyed, [key], ["artist_popularity", "followers"])
    return best.drop("artist_name")


def album_dimension(albums: DataFrame) -> DataFrame:
    """The most popular album row per track."""
    slim = require(select_existing(albums, ["track_id", *schemas.ALBUM_ATTRIBUTES]), ["track_id"])
    return dedup_best(slim, ["track_id"], ["album_popularity"])


def chart_dimension(charts: DataFrame, unique_keys: bool = True) -> DataFrame:
    """Chart entries keyed by ``join_track`` and ``join_artist``.

    With ``unique_keys`` the entry with most streams stands for its key; without
    it every entry stays.
    """
    names = ["track_name", "artist_name"]
    slim = require(select_existing(charts, [*names, *schemas.CHART_ATTRIBUTES]), names)
    keyed = normalize_key(slim, "track_name", "join_track")
    keyed = normalize_key(keyed, "artist_name", "join_artist").drop(*names)
    if not unique_keys:
        return keyed
    return dedup_best(keyed, ["join_track", "join_artist"], ["streams"])


def with_join_keys(tracks: DataFrame) -> DataFrame:
    keyed = normalize_key(tracks, "artist_name", "join_artist")
    return normalize_key(keyed, "track_name", "join_track")


def enrich_artists(
    tracks: DataFrame, artists: DataFrame, unique_keys: bool = True, hot: Sequence[int] = ()
) -> DataFrame:
    """Tracks with artist attributes by normalised artist name."""
    keyed = normalize_key(tracks, "artist_name", "join_artist")
    return left_join(keyed, artist_dimension(artists, unique_keys), ["join_artist"], hot)


def enrich_albums(tracks: DataFrame, albums: DataFrame) -> DataFrame:
    """Tracks with album attributes by track id."""
    return left_join(tracks, album_dimension(albums), ["track_id"])


def enrich_charts(
    tracks: DataFrame, charts: DataFrame, unique_keys: bool = True, hot: Sequence[int] = ()
) -> DataFrame:
    """Tracks with chart attributes by normalised track and artist name."""
    join = left_join if unique_keys else repeating_join
    return join(
        with_join_keys(tracks), chart_dimension(charts, unique_keys),
        ["join_track", "join_artist"], hot,
    )
