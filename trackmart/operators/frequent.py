"""Frequent items in bounded space, with bounds on their counts.

A sketch has at most ``k`` names with a lower bound of their counts, and one
number, the most that any count can be above it. Sketches of parts add up to one
of the whole: counts are summed, and what the name after the ``k``-th has is
taken from all, which that many names lose together. So over ``n`` rows the
bounds are at most n / (k + 1) apart, in whatever order parts are merged.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sketch_of(counts: DataFrame, k: int) -> DataFrame:
    """The sketch of exact ``counts`` (name, plays) as rows (name, low, error).

    Its row without a name has the error; a NULL name is none of its own.
    """
    rows = counts.filter("name is not null").select(
        "name", F.col("plays").alias("low"), F.lit(0).cast("long").alias("error"))
    return merge_sketches(rows, k)


def merge_sketches(rows: DataFrame, k: int) -> DataFrame:
    """One sketch from the rows of any number of them.

    Names are summed where they are before they move; ``k`` + 1 rows meet in a task.
    """
    summed = rows.groupBy("name").agg(F.sum("low").alias("low"), F.sum("error").alias("error"))
    # The row without a name goes along: it comes first.
    first = summed.orderBy(F.col("name").isNotNull(), F.desc("low"), "name").limit(k + 2)
    one = first.agg(
        F.collect_list(F.when(F.col("name").isNotNull(), F.struct("low", "name"))).alias("items"),
        F.coalesce(F.sum(F.when(F.col("name").isNull(), F.col("error"))), F.lit(0)).alias("error"))
    items = F.sort_array("items", asc=False)
    cut = F.coalesce(F.get(items, F.lit(k))["low"], F.lit(0))
    kept = F.filter(F.transform(F.slice(items, 1, k), lambda i: F.struct(
        i["name"].alias("name"), (i["low"] - F.col("cut")).alias("low"),
        F.lit(0).cast("long").alias("error"))), lambda i: i["low"] > 0)
    rest = F.array(F.struct(F.lit(None).cast("string").alias("name"),
                            F.lit(0).cast("long").alias("low"),
                            (F.col("error") + F.col("cut")).alias("error")))
    return one.withColumn("cut", cut).select(F.inline(F.concat(kept, rest)))


def merger(k: int):
    """``merge_sketches`` for tables of parts."""
    return partial(merge_sketches, k=k)


def bounds(sketch: DataFrame) -> DataFrame:
    """(name, lower, upper) of the names in a sketch; others have at most its error."""
    error = sketch.filter("name is null").agg(F.max("error")).scalar()
    return sketch.filter("name is not null").select(
        "name", F.col("low").alias("lower"), (F.col("low") + error).alias("upper"))
