"""The whole run: raw files to clean, joined, curated and published tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.ml import popularity as P
from trackmart.operators import aggregates
from trackmart.operators.quality import (
    check_fanout,
    check_keys,
    join_conditions,
    observed,
    step_metrics,
)
from trackmart.plans import cleaning, star
from trackmart.plans.ledger import Ledger, described, digest_of
from trackmart.plans.master import build_master, master_forecast
from trackmart.sources import manifest
from trackmart.sources.lake import (
    LakePaths,
    export_csv,
    read_csv,
    write_bucketed,
    write_layer,
)
from trackmart.sources.records import read_lines_watched

# Raw file names, to be replaced by those of the lake.
RAW_FILES = {
    "tracks": "tracks.csv", "charts": "charts.csv", "artists": "artists.csv",
    "albums": "albums.csv",
}
BY_TRACK = ("tracks", "albums")
CLEANERS = {
    "tracks": cleaning.clean_tracks, "charts": cleaning.clean_charts,
    "artists": cleaning.clean_artists, "albums": cleaning.clean_albums,
}


@dataclass(frozen=True)
class CurateSettings:
    """Years of the trend, and the lengths of the two top lists."""

    years: tuple[int, int] = (2009, 2024)
    label_k: int = 30
    artist_k: int = 50


@dataclass(frozen=True)
class RunReport:
    steps: DataFrame
    matched_artists: int
    chart_hits: int
    fanout_ok: bool
    tables: dict[str, DataFrame]
    raw: DataFrame
    run_id: str
    reused: list[str]


def stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a layer dataset and continue from its files."""
    write_layer(df, path)
    return spark.read.schema(df.schema).parquet(path)


def check_raw(
    spark: SparkSession, paths: LakePaths, expected: DataFrame | None = None,
    run_id: str | None = None,
) -> tuple[DataFrame, bool]:
    """Status of the expected raw files, logged, and whether all are fine."""
    expected = manifest.expected_files(spark) if expected is None else expected
    status = stored(
        spark, manifest.check_manifest(spark, expected, paths.root, "raw"), paths.raw("last_check")
    )
    manifest.append_log(status, paths.raw("ingestion_log"), run_id)
    return status, manifest.manifest_verdict(status).first()["all_ok"]


def raw_digests(
    spark: SparkSession, paths: LakePaths, files: Mapping[str, str]
) -> dict[str, str | None]:
    """What tells one state of each raw file from another."""
    names = {f"raw/{file}": name for name, file in files.items()}
    found = manifest.list_datasets(spark, paths.root, "raw").filter(F.col("path").isin(list(names)))
    digests = {names[row["path"]]: row["digest"] for row in found.collect()}
    return {name: digests.get(name) for name in files}


def clean_one(
    spark: SparkSession, paths: LakePaths, name: str, path: str, multi_line: bool = False,
    table_prefix: str | None = None,
) -> dict:
    """Clean and store one raw file; rows in and out are counted while writing.

    The file is read once, by lines. Where that finds a line that does not close
    a quote, the result is replaced by that of reading whole records, and so it
    is from the start with ``multi_line``.
    """
    def store(raw: DataFrame) -> tuple[DataFrame, int]:
        result, kept = observed(CLEANERS[name](raw), f"{name}_out")
        if table_prefix and name in BY_TRACK:
            table = f"{table_prefix}_{name}"
            done = write_bucketed(result, paths.processed(name), table, "track_id")
        else:
            done = stored(spark, result, paths.processed(name))
        return done, kept.get["rows"]

    if not multi_line:
        raw, seen = read_lines_watched(spark, path, f"{name}_in")
        done, rows_out = store(raw)
        multi_line = seen.get["open_lines"] > 0
    if multi_line:
        raw, seen = observed(read_csv(spark, path, multi_line=True), f"{name}_in")
        done, rows_out = store(raw)
    return {**described(done, paths.processed(name)), "rows": [seen.get["rows"], rows_out]}


def aggregated(master: DataFrame, settings: CurateSettings) -> dict[str, DataFrame]:
    """Aggregates and model rows of a stored master table, without the top artists."""
    return {
        "agg_genre": aggregates.agg_genre(master),
        "agg_year": aggregates.agg_year(master, *settings.years),
        "agg_label": aggregates.agg_label(master, settings.label_k),
        "agg_hit_vs_nohit": aggregates.agg_hit(master),
        "artist_profiles": aggregates.artist_profiles(master),
        "master_ml": aggregates.master_ml(master),
    }


def export_reports(curated: Mapping[str, DataFrame], folder: str) -> None:
    """The aggregates as CSV for spreadsheets and dashboards."""
    for name, df in curated.items():
        if name.startswith("agg_"):
            export_csv(df, f"{folder}/{name}")


def published_tables(
    curated: Mapping[str, DataFrame], extra: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The tables of the star schema; ``extra`` adds the model result tables."""
    return {
        "fact_popularity": star.fact_popularity(curated["master_ml"]),
        "dim_tracks": star.dim_tracks(curated["master_ml"]),
        "dim_artists": curated["artist_profiles"],
        "agg_genre": curated["agg_genre"],
        "agg_year": curated["agg_year"],
        "agg_label": curated["agg_label"],
        "agg_hit_vs_nohit": curated["agg_hit_vs_nohit"],
        **(extra or {}),
    }


def key_report(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The key check of each published table."""
    return {name: check_keys(df, schemas.TABLE_KEYS[name]) for name, df in tables.items()}


def train_models(
    model_rows: DataFrame, settings: P.ForestSettings = P.ForestSettings()
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Both forests on stored model rows: their result tables, and the predictions
    of the full model on the held-out rows."""
    metrics, importance, predictions = {}, {}, None
    train, test = P.hash_split(model_rows, ["track_id"])
    for name, features in [(P.FULL, P.FULL_FEATURES), (P.AUDIO, P.AUDIO_FEATURES)]:
        model = P.fit_popularity(P.prepare(train, features), features, settings=settings)
        scored = P.score(model, P.prepare(test, features))
        metrics[name] = P.regression_metrics(scored, "popularity", "predicted_popularity")
        importance[name] = P.importance_table(model, model_rows.sparkSession)
        if name == P.FULL:
            predictions = P.prediction_table(scored)
    tables = {
        "ml_metrics": P.stack_models(metrics),
        "ml_feature_importance": P.stack_models(importance),
    }
    return tables, predictions


def run_flow(
    spark: SparkSession,
    paths: LakePaths,
    publish_folder: str | None = None,
    files: Mapping[str, str] = RAW_FILES,
    unique_keys: bool = True,
    hot_share: float | None = None,
    multi_line: bool = False,
    forest: P.ForestSettings | None = None,
    csv_folder: str | None = None,
    table_prefix: str | None = None,
    settings: CurateSettings = CurateSettings(),
    expected: DataFrame | None = None,
    fanout_limit: float | None = None,
    resume: bool = False,
    until: str | None = None,
) -> RunReport:
    """Raw to published in one session, each dataset written once as Parquet.

    Step zero checks the raw files against ``expected``, by default that all of
    ``files`` are there, and logs the result; a missing one stops the run. A
    file is read by lines, and by whole records where that finds line breaks
    inside quotes; ``multi_line`` reads records at once. ``hot_share`` looks for
    frequent names first and salts their joins, for dimensions too large to
    broadcast. The rows of the master table are foretold before it is joined;
    with a ``fanout_limit`` a forecast beyond it stops the run there.

    With ``forest`` settings both models are trained and their tables published;
    with a ``csv_folder`` the aggregates are exported there as well. With a
    ``table_prefix`` the largest join runs on bucketed tables, without a shuffle.

    A ledger below the lake keeps what every step read and found. With
    ``resume`` a step that would read the same again is not done again; the
    report names those. ``until`` ends the run after a step, by a StoppedRun.
    """
    run_id = uuid.uuid4().hex
    ledger = Ledger(spark, f"{paths.root.rstrip('/')}/run_ledger", resume, until)
    if expected is None:
        expected = manifest.expected_files(
            spark, [(file, f"raw/{file}", name, 1) for name, file in files.items()])
    raw, _ = check_raw(spark, paths, expected, run_id)
    missing = [row["file"] for row in raw.filter(F.col("status") == manifest.MISSING).collect()]
    if missing:
        raise FileNotFoundError(f"the raw layer lacks {sorted(missing)}")

    reads = {
        name: digest_of("clean", digest, multi_line, table_prefix)
        for name, digest in raw_digests(spark, paths, files).items()
    }
    clean, counts = {}, {}
    for name in CLEANERS:
        facts = ledger.step(f"clean_{name}", reads[name], partial(
            clean_one, spark, paths, name, paths.raw(files[name]), multi_line, table_prefix))
        bucketed = table_prefix and name in BY_TRACK
        clean[name] = spark.table(f"{table_prefix}_{name}") if bucketed else ledger.dataset(facts)
        counts[f"clean_{name}"] = tuple(facts["rows"])
    base_rows = counts["clean_tracks"][1]

    def join() -> dict:
        forecast = base_rows
        if not unique_keys:  # else every track has one match at most
            forecast = master_forecast(
                clean["tracks"], clean["artists"], clean["charts"], unique_keys
            ).first()["forecast_rows"]
        if fanout_limit is not None and not check_fanout(base_rows, forecast, fanout_limit):
            raise ValueError(f"{base_rows} tracks would become {forecast} rows")
        built = build_master(
            clean["tracks"], clean["artists"], clean["albums"], clean["charts"],
            unique_keys, hot_share,
        )
        built, seen = observed(built, "master_out", join_conditions())
        done = stored(spark, built, paths.processed("joined"))
        return {**described(done, paths.processed("joined")), **seen.get, "forecast": forecast}

    joined_reads = digest_of("join", reads, unique_keys)
    after_join = ledger.step("build_master", joined_reads, join)
    master = ledger.dataset(after_join)

    curated, curated_reads = {}, digest_of("curate", joined_reads, settings)
    def curate(name: str, df: DataFrame) -> None:
        path = paths.curated(name)
        facts = ledger.step(name, curated_reads, lambda: described(stored(spark, df, path), path))
        curated[name] = ledger.dataset(facts)

    for name, df in aggregated(master, settings).items():
        curate(name, df)
    # The top artists are among the stored profiles: the master table is not read for them.
    curate("agg_artist", aggregates.top_artists(curated["artist_profiles"], settings.artist_k))
    if csv_folder is not None:
        export_reports(curated, csv_folder)

    results = {}
    if forest is not None:
        def train() -> dict:
            tables, predictions = train_models(curated["master_ml"], forest)
            made = {**tables, "ml_predictions": predictions}
            return {n: described(stored(spark, df, paths.curated(n)), paths.curated(n))
                    for n, df in made.items()}

        made = ledger.step("train_models", digest_of("train", curated_reads, forest), train)
        results = {n: ledger.dataset(f) for n, f in made.items() if n != "ml_predictions"}

    tables = published_tables(curated, results)
    if publish_folder is None:
        published = star.publish_all(tables)
    else:
        ledger.step("publish", digest_of("publish", curated_reads, forest, publish_folder),
                    lambda: {"tables": sorted(star.publish_all(tables, publish_folder))})
        published = star.read_published(spark, publish_folder)
    steps = step_metrics(spark, {**counts, "build_master": (base_rows, after_join["rows"])})
    return RunReport(
        steps, after_join["matched_artists"], after_join["chart_hits"],
        check_fanout(base_rows, after_join["forecast"]), published, raw, run_id, ledger.reused,
    )
