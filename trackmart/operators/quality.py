"""Step metrics, fan-out guard, table counts and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FANOUT_LIMIT = 1.05


def observed(
    df: DataFrame, name: str, conditions: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """Count rows, and rows meeting each condition, while ``df`` is written."""
    observation = Observation(name)
    counts = [
        F.count_if(condition).alias(label) for label, condition in (conditions or {}).items()
    ]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def join_conditions() -> dict[str, Column]:
    """Matches worth counting on the master table."""
    return {
        "matched_artists": F.col("artist_id").isNotNull(),
        "chart_hits": F.col("is_chart_hit") == 1,
    }


def step_metrics(spark: SparkSession, steps: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Rows in, out and removed for each named step."""
    rows = [(name, before, after, before - after) for name, (before, after) in steps.items()]
    return spark.createDataFrame(
        rows, "step string, rows_in bigint, rows_out bigint, rows_removed bigint"
    )


def check_fanout(base_rows: int, joined_rows: int, limit: float = FANOUT_LIMIT) -> bool:
    """Whether the joined table stays within ``limit`` times the base rows."""
    return joined_rows <= base_rows * limit


def fanout_report(
    base: DataFrame, joined: DataFrame, limit: float = FANOUT_LIMIT, times: str | None = None
) -> DataFrame:
    """Row counts of two tables and the verdict of the guard, as one row.

    Where a row of ``joined`` stands for several, the column ``times`` says for how many.
    """
    rows = F.count(F.lit(1))
    if times is not None:
        total = F.sum(F.col(times).cast("decimal(38,0)"))
        rows = F.coalesce(total, F.lit(0)).cast("bigint")
    counted = joined.agg(rows.alias("joined_rows"))
    both = counted.withColumn("base_rows", base.agg(F.count(F.lit(1))).scalar())
    within = F.col("joined_rows") <= F.col("base_rows") * F.lit(limit)
    return both.withColumn("within_limit", within)


def fanout_forecast(
    left: DataFrame, rights: Sequence[tuple[DataFrame, Sequence[str]]],
    limit: float = FANOUT_LIMIT,
) -> DataFrame:
    """(base_rows, forecast_rows, within_limit): the rows that left joins will give, as one row.

    A left row comes out once for each combination of its matches, or once
    without any, and its matches are the rows of the right sides with its keys.
    So counts per key on either side are enough: each side is read once, counted
    before it moves, and no row is joined. ``rights`` are the right sides with
    the columns they are joined on; a NULL key has no match.
    """
    keys = list(dict.fromkeys(key for _, on in rights for key in on))
    counted = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    times = F.col("_rows").cast("decimal(38,0)")
    for number, (right, on) in enumerate(rights):
        matches = right.groupBy(*on).agg(F.count(F.lit(1)).alias(f"_{number}"))
        counted = counted.join(matches, list(on), "left")
        times = (times * F.coalesce(F.col(f"_{number}"), F.lit(1))).cast("decimal(38,0)")
    sums = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("base_rows"),
                       F.coalesce(F.sum(times), F.lit(0)).cast("bigint").alias("forecast_rows"))
    within = F.col("forecast_rows") <= F.col("base_rows") * F.lit(limit)
    return sums.withColumn("within_limit", within)


def table_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row count per table; an error status where the table is missing."""
    parts = []
    for name in names:
        if spark.catalog.tableExists(name):
            count = spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
            status = "OK"
        else:
            count = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
            status = "ERROR"
        parts.append(count.select(F.lit(name).alias("table_name"), "row_count",
                                  F.lit(status).alias("status")))
    return reduce(DataFrame.unionByName, parts)


def check_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that repeat, rows they hold, and rows with a NULL key, as one row."""
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = whole & (F.col("n") > 1)
    return counted.agg(
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(~whole, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def stack_tagged(tables: Mapping[str, DataFrame | None], tag: str = "model_name") -> DataFrame:
    """Stack tables by column name with the name of each in ``tag``; None is skipped."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items() if df is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
