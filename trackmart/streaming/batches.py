"""Statistics per fixed-count batch of events and over all batches.

The functions take bounded DataFrames with a ``batch`` number and an arrival
number ``seq``; the live forms in ``live`` call them on each micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.operators.dedup import number_rows, top_k, top_k_per
from trackmart.streaming.events import event_defaults, with_display_key

TOP = 5


def assign_batches(
    events: DataFrame, order: Sequence[str], size: int = 100, tasks: int | None = None
) -> DataFrame:
    """Arrival number and batch number: ``size`` events each, the last may be short."""
    numbered = number_rows(events, order, tasks=tasks)
    return numbered.withColumn("batch", F.expr(f"(seq - 1) div {int(size)} + 1"))


def track_plays(events: DataFrame) -> DataFrame:
    """Plays per batch and track."""
    named = with_display_key(event_defaults(events))
    return named.groupBy("batch", "track").agg(
        F.count(F.lit(1)).alias("plays"), F.min("seq").alias("first_seq")
    )


def genre_plays(events: DataFrame) -> DataFrame:
    """Plays and mean listened time per batch and genre."""
    return event_defaults(events).groupBy("batch", "genre").agg(
        F.count(F.lit(1)).alias("plays"),
        F.avg("play_duration_ms").alias("avg_duration_ms"),
        F.min("seq").alias("first_seq"),
    )


def _most_played_first() -> list[Column]:
    return [F.desc("plays"), F.asc("first_seq")]


def top_tracks(events: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` most played tracks of each batch, ties by first play."""
    ranked = top_k_per(track_plays(events), ["batch"], k, _most_played_first())
    return ranked.select("batch", "rank", "track", "plays")


def top_genres(events: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` most played genres of each batch with their mean seconds."""
    ranked = top_k_per(genre_plays(events), ["batch"], k, _most_played_first())
    return ranked.select(
        "batch", "rank", "genre", "plays",
        F.round(F.col("avg_duration_ms") / 1000, 1).alias("avg_seconds"),
    )


def batch_sizes(events: DataFrame) -> DataFrame:
    return events.groupBy("batch").agg(F.count(F.lit(1)).alias("batch_size"))


def batch_summary(events: DataFrame, name_width: int | None = None) -> DataFrame:
    """One row per batch: size, top track, top two genres; '' and 0 when absent.

    Each event counts once for its batch, its track and its genre. The three
    counts come from one pass, are summed up before they move, and only the top
    two names of each kind go on to the row of the batch. ``name_width`` cuts the
    track's name for display; None keeps it whole.
    """
    return summarise(batch_counts(events), name_width)


def batch_counts(events: DataFrame) -> DataFrame:
    """(batch, kind, name, plays, first_seq): the size, tracks and genres of each batch.

    Counts of parts of a batch add up to those of the batch, see ``merge_counts``.
    """
    named = with_display_key(event_defaults(events))
    counted = named.select("batch", "seq", F.explode(F.create_map(
        F.lit("size"), F.lit(""), F.lit("track"), F.col("track"), F.lit("genre"), F.col("genre"),
    )).alias("kind", "name"))
    return counted.groupBy("batch", "kind", "name").agg(
        F.count(F.lit(1)).alias("plays"), F.min("seq").alias("first_seq")
    )


def merge_counts(parts: DataFrame) -> DataFrame:
    """The counts of whole batches from those of their parts."""
    return parts.groupBy("batch", "kind", "name").agg(
        F.sum("plays").alias("plays"), F.min("first_seq").alias("first_seq")
    )


def summarise(counts: DataFrame, name_width: int | None = None) -> DataFrame:
    """The summary rows of batch counts."""
    top = top_k_per(counts, ["batch", "kind"], 2, _most_played_first())

    def at(kind: str, rank: int, column: str, default) -> Column:
        hit = (F.col("kind") == kind) & (F.col("rank") == rank)
        return F.coalesce(F.max(F.when(hit, F.col(column))), F.lit(default))

    first = at("track", 1, "name", "")
    rows = top.groupBy("batch").agg(
        at("size", 1, "plays", 0).alias("batch_size"),
        (first if name_width is None else F.substring(first, 1, name_width)).alias("top_track_1"),
        at("track", 1, "plays", 0).alias("top_track_1_plays"),
        at("genre", 1, "name", "").alias("top_genre_1"),
        at("genre", 1, "plays", 0).alias("top_genre_1_plays"),
        at("genre", 2, "name", "").alias("top_genre_2"),
        at("genre", 2, "plays", 0).alias("top_genre_2_plays"),
    )
    return rows.withColumnRenamed("batch", "batch_number")


def stream_totals(summary: DataFrame) -> DataFrame:
    """Batches and events over all batch summaries."""
    return summary.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("batch_size"), F.lit(0)).alias("events"),
    )


def genre_totals_topk(top: DataFrame, k: int = 10) -> DataFrame:
    """Genres by the sum of their top-five counts, which undercounts.

    A genre earns nothing in a batch where it is sixth or lower; ``genre_totals``
    has the exact sums. Ties go to the genre listed first.
    """
    summed = top.groupBy("genre").agg(
        F.sum("plays").alias("plays"), F.min(F.struct("batch", "rank")).alias("first")
    )
    top = top_k(summed, k, [F.desc("plays"), F.asc("first")])
    return top.select("genre", F.col("plays").alias("plays_undercounted"))


def genre_totals(events: DataFrame) -> DataFrame:
    """Exact plays per genre, on a bounded table or a stream."""
    return event_defaults(events).groupBy("genre").agg(F.count(F.lit(1)).alias("plays"))
