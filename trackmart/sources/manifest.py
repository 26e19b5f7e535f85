"""Raw-layer check: expected files against files present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart import schemas

# The expected raw files and what they hold; their least sizes are fixed values.
EXPECTED_FILES = [
    ("tracks.csv", "raw/tracks.csv", "Track catalogue, the primary dataset", 50_000_000),
    ("charts.csv", "raw/charts.csv", "Most streamed songs, the chart hits", 10_000),
    ("artists.csv", "raw/artists.csv", "Artist profiles", 1_000_000),
    ("albums.csv", "raw/albums.csv", "Album and track metadata", 50_000_000),
]
# The status texts.
OK = "OK"
TOO_SMALL = "WARNING — file smaller than expected"
MISSING = "MISSING"
NO_SIZE = "—"


def expected_files(
    spark: SparkSession, files: Sequence[tuple[str, str, str, int]] = EXPECTED_FILES
) -> DataFrame:
    return spark.createDataFrame(list(files), schemas.MANIFEST)


def size_text(size: Column) -> Column:
    """Bytes in decimal units with two places; NULL for an unknown size."""
    def scaled(unit: int, name: str) -> Column:
        return F.format_string(f"%.2f {name}", size.cast("double") / F.lit(float(unit)))

    return (
        F.when(size.isNull(), F.lit(None))
        .when(size >= 1_000_000_000, scaled(1_000_000_000, "GB"))
        .when(size >= 1_000_000, scaled(1_000_000, "MB"))
        .when(size >= 1_000, scaled(1_000, "KB"))
        .otherwise(F.format_string("%d B", size))
    )


def list_files(spark: SparkSession, root: str, folder: str = "") -> DataFrame:
    """Path below ``root``, size and time of every file in ``folder``; no content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(f"{root.rstrip('/')}/{folder}")
        .select("path", "length", "modificationTime")
    )
    # Only the part after the root is compared, whatever the scheme in front.
    tail = root.rstrip("/").split("://")[-1].split(":")[-1].lstrip("/")
    below = F.regexp_replace(F.col("path"), r"^.*?\Q" + tail + r"\E/", "")
    return files.select(
        below.alias("path"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
    )


def manifest_status(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Status, size and note per expected file, given a listing of paths and sizes."""
    # Object stores list a path once; the aggregate makes that certain.
    found = present.groupBy("path").agg(F.max("size_bytes").alias("size_bytes"))
    joined = expected.join(found, on="path", how="left")
    size = F.col("size_bytes")
    status = (
        F.when(size.isNull(), F.lit(MISSING))
        .when(size < F.col("min_size_bytes"), F.lit(TOO_SMALL))
        .otherwise(F.lit(OK))
    )
    note = (
        F.when(size.isNull(), F.lit("Not in the raw layer: add the file, then run again."))
        .when(
            size < F.col("min_size_bytes"),
            F.concat(F.lit("At least "), size_text(F.col("min_size_bytes")),
                     F.lit(" are due: the file is cut or another one.")),
        )
        .otherwise(F.lit("Present with its full size."))
    )
    return joined.select(
        F.col("name").alias("file"),
        "path",
        "description",
        status.alias("status"),
        F.coalesce(size_text(size), F.lit(NO_SIZE)).alias("size"),
        note.alias("note"),
    )


def list_datasets(spark: SparkSession, root: str, folder: str = "") -> DataFrame:
    """(path, size_bytes, files, digest) of every file in ``folder`` and of every folder that holds
    some, with the sum of their sizes.

    The digest changes with the path, size and time of every file.
    """
    depth = F.size(F.split("path", "/"))
    above = F.transform(F.sequence(F.lit(1), depth),
                        lambda n: F.array_join(F.slice(F.split("path", "/"), 1, n), "/"))
    one = F.xxhash64("path", "size_bytes", "modified").cast("decimal(38,0)")
    listed = list_files(spark, root, folder).select(
        F.explode(above).alias("dataset"), "size_bytes", one.alias("one"))
    return listed.groupBy(F.col("dataset").alias("path")).agg(
        F.sum("size_bytes").alias("size_bytes"), F.count(F.lit(1)).alias("files"),
        F.sum("one").cast("string").alias("digest"))


def check_manifest(
    spark: SparkSession, expected: DataFrame, root: str, folder: str = ""
) -> DataFrame:
    """Status of the expected files, or folders of files, in ``folder`` below ``root``."""
    return manifest_status(expected, list_datasets(spark, root, folder))


def manifest_verdict(status: DataFrame) -> DataFrame:
    """One row: whether every file is fine, and how many are not."""
    return status.agg(
        F.coalesce(F.bool_and(F.col("status") == OK), F.lit(True)).alias("all_ok"),
        F.count_if(F.col("status") != OK).alias("files_to_fix"),
    )


def action_items(status: DataFrame) -> DataFrame:
    return status.filter(F.col("status") != OK).select("file", "note")


def append_log(status: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add this check to the ingestion log table, under the id of its run."""
    dated = status.withColumns({
        "run_timestamp": F.current_timestamp(), "run_id": F.lit(run_id).cast("string")})
    dated.write.mode("append").parquet(path)
