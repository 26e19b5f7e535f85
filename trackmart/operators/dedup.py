"""One row per key, top-k and ordered row numbering."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart.session import written


def _remaining_order(df: DataFrame, used: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in used]


def dedup_best(df: DataFrame, keys: Sequence[str], best: Sequence[str]) -> DataFrame:
    """The row with the highest ``best`` values per key, NULLs last.

    Ties fall to the largest values of the other columns, so that a rerun keeps
    the same row. As an aggregate it keeps one row per key in each map task
    before the shuffle, and Spark knows the keys are unique: a later left join
    whose columns nobody reads is dropped from the plan.
    """
    others = [c for c in df.columns if c not in keys and c not in best]
    row = F.struct(*[F.col(f"`{c}`") for c in [*best, *others]])
    kept = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return kept.select(*keys, "_row.*").select(df.columns)


def dedup_any(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The first row per key by ``order``, then by all other columns.

    The rank limit keeps one row per key in each map task before the shuffle,
    which also thins a hot key. Where the other columns are all text, a row is
    sorted and moved as one packed text, which takes less room.
    """
    first = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    kinds = dict(df.dtypes)
    if len(first) > 1 and all(kinds.get(c) == "string" for c in first):
        packed = df.select(*keys, _packed(first).alias("_row"))
        kept = top_k_per(packed, keys, 1, [F.col("_row")], "_rank")
        # As a generated value a row is unpacked once, whatever filters read its columns.
        parts = kept.select(*keys, F.explode(F.array(_unpacked("_row"))).alias("_parts"))
        values = [F.col("_parts")[place].alias(name) for place, name in enumerate(first)]
        return parts.select(*keys, *values).select(*[F.col(f"`{c}`") for c in df.columns])
    by = [F.col(c).asc_nulls_last() for c in order]
    by += _remaining_order(df, [*keys, *order])
    return top_k_per(df, keys, 1, by, "_rank").drop("_rank")


# The end of a text, and a NUL inside one: texts sort as the columns do, a shorter one first.
_END, _NUL = "\0\0", "\0\1"


def _packed(columns: Sequence[str]) -> Column:
    """Text columns as one text that sorts as they do in turn, NULLs last."""
    def one(name: str) -> Column:
        text = F.replace(F.col(f"`{name}`"), F.lit("\0"), F.lit(_NUL))
        return F.coalesce(F.concat(F.lit("0"), text), F.lit("1"))

    return F.concat_ws(_END, *map(one, columns))


def _unpacked(row: str) -> Column:
    """The values of a ``_packed`` text, as an array.

    One function over all of them: written out for each column, and again in each filter, the
    code of a row outgrows what the JVM compiles, and is interpreted.
    """
    def one(part: Column) -> Column:
        text = F.replace(F.substring(part, 2, 2**31 - 1), F.lit(_NUL), F.lit("\0"))
        return F.when(part.startswith("0"), text)

    return F.transform(F.split(row, _END), one)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per(
    df: DataFrame, partition: Sequence[str], k: int, order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each partition with their rank."""
    ranked = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(ranked)).filter(F.col(rank) <= k)


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "seq", tasks: int | None = None
) -> DataFrame:
    """Consecutive numbers from 1 in the given order, without a single-task sort.

    The rows are range-partitioned and sorted by the order columns, ties by their
    place in the input, so that even one value held by a third of the table
    splits over tasks. Each task numbers its own rows; written once, the positions
    stay fixed, and only one count per partition passes through the driver.
    ``tasks`` is the number of partitions, by default that of the session's
    shuffles.

    ``df`` must read files by way of filters and projections, so that a retried
    task sees the same places; pass ``written(df, ...)`` where it does not.
    """
    spark = df.sparkSession
    by = [F.col(c).asc_nulls_last() for c in [*order, "_place"]]
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        df.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(tasks, *by)
        .sortWithinPartitions(*by)
        .drop("_place")
    )
    # The id holds the partition number above bit 33 and the position below.
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).withColumns({
        "_part": F.shiftright("_id", 33).cast("int"),
        "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    }).drop("_id")
    kept = written(placed, "numbered")
    sizes = kept.groupBy("_part").count().orderBy("_part").collect()
    starts = accumulate([row["count"] for row in sizes], initial=0)
    offsets = spark.createDataFrame(
        [(row["_part"], start) for row, start in zip(sizes, starts)], "_part int, _start bigint"
    )
    # One row per shuffle partition, so the broadcast does not grow with the data.
    numbered = kept.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, F.col("_start") + F.col("_pos") + 1).drop(
        "_part", "_pos", "_start"
    )
