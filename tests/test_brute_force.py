"""Random small inputs against plain Python written from the stated rules."""

import random
from collections import Counter, defaultdict

import pytest
from table_rows import rows

from trackmart import schemas
from trackmart.operators import dedup, joins
from trackmart.streaming import batches


def first_seen_ranking(names):
    """Names by count, ties in the order of their first appearance."""
    counts = Counter(names)
    order = {name: i for i, name in reversed(list(enumerate(names)))}
    return sorted(counts.items(), key=lambda item: (-item[1], order[item[0]]))


@pytest.mark.parametrize("seed", range(3))
def test_batch_statistics(spark, seed):
    rng = random.Random(seed)
    size = rng.choice([7, 20, 64])
    stream = [
        {"event_id": f"{i:05d}", "track_name": rng.choice(["S", "T", None, "U" * 60]),
         "artist_name": rng.choice(["A", "B", None]),
         "genre": rng.choice(["pop", "rock", "jazz", "folk", "soul", "rap", None]),
         "play_duration_ms": rng.choice([None, 1000, 2500, 30001])}
        for i in range(rng.randint(100, 300))
    ]
    df = spark.createDataFrame(
        [tuple(e.get(n) for n in schemas.EVENT.names) for e in stream], schemas.EVENT
    )
    numbered = batches.assign_batches(df.repartition(3), ["event_id"], size)
    tracks, genres, summary, totals = [], [], [], defaultdict(int)
    for number, start in enumerate(range(0, len(stream), size), 1):
        batch = stream[start:start + size]
        names = [f"{e['track_name'] or 'Unknown'} — {e['artist_name'] or 'Unknown'}" for e in batch]
        kinds = [e["genre"] or "unknown" for e in batch]
        top_tracks, top_genres = first_seen_ranking(names)[:5], first_seen_ranking(kinds)[:5]
        tracks += [(number, i, *t) for i, t in enumerate(top_tracks, 1)]
        genres += [(number, i, *g) for i, g in enumerate(top_genres, 1)]
        second = top_genres[1] if len(top_genres) > 1 else ("", 0)
        summary.append((number, len(batch), top_tracks[0][0], top_tracks[0][1],
                        *top_genres[0], *second))
        for genre, n in top_genres:
            totals[genre] += n
    assert rows(batches.top_tracks(numbered)) == sorted(tracks, key=repr)
    assert rows(batches.top_genres(numbered).drop("avg_seconds")) == sorted(genres, key=repr)
    assert rows(batches.batch_summary(numbered)) == sorted(summary, key=repr)
    assert [tuple(r) for r in batches.genre_totals_topk(batches.top_genres(numbered)).collect()] == (
        sorted(totals.items(), key=lambda item: -item[1])
    )


@pytest.mark.parametrize("seed", range(3))
def test_best_row_and_left_join(spark, seed):
    rng = random.Random(seed)
    artists = [
        (rng.choice(["Abba", "ABBA", " abba", "Other", "x", None]), str(i),
         rng.choice([None, 1, 2, 3]), rng.randint(0, 3))
        for i in range(40)
    ]
    tracks = [(str(i), rng.choice(["abba", "OTHER", "none", None])) for i in range(30)]
    artist_rows = spark.createDataFrame(
        artists, "artist_name string, artist_id string, artist_popularity int, followers long"
    )
    track_rows = spark.createDataFrame(tracks, "track_id string, artist_name string")

    def normal(name):
        return None if name is None else name.lower().strip(" ")

    def joined(key):
        best = {}
        for row in artists:
            if row[0] is None:
                continue
            # A missing popularity ranks below every other.
            rank = (-1 if row[2] is None else row[2], row[3], row[0], row[1])
            if key(row[0]) not in best or rank > best[key(row[0])][0]:
                best[key(row[0])] = (rank, row)
        kept = [row for _, row in best.values()]
        out = []
        for track, name in tracks:
            found = [r[1] for r in kept if name is not None and normal(r[0]) == normal(name)]
            out += [(track, artist) for artist in (found or [None])]
        return sorted(out, key=repr)

    for unique, key in [(True, normal), (False, lambda name: name)]:
        got = joins.enrich_artists(track_rows, artist_rows, unique_keys=unique)
        assert rows(got.select("track_id", "artist_id")) == joined(key)


@pytest.mark.parametrize("seed", range(2))
def test_numbering(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, 1, 2, 2, 2, 3]) for _ in range(200)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    got = rows(dedup.number_rows(df.repartition(5, "i"), ["v", "i"]), "seq")
    wanted = sorted(((v, i) for i, v in enumerate(values)), key=lambda p: (p[0] is None, p[0] or 0, p[1]))
    assert [(v, i) for v, i, _ in got] == wanted
    assert [n for _, _, n in got] == list(range(1, 201))
