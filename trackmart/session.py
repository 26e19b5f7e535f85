"""Session defaults and the shared folder for data that cuts a lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

_local_folder: str | None = None


def build_session(app_name: str = "trackmart", **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    overrides = {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="trackmart-")
    return _local_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    application = spark.conf.get("spark.app.id", "application")
    return f"{shared_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go when a query ends, not when the driver's memory is
    next cleared."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the files.

    The rows survive the loss of an executor and later passes read only the
    columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
