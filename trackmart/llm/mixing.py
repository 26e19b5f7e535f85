"""Mixing sources to target weights by systematic sampling (operator 8).

Only DataFrame operations. Every document of a source expects the same number
of copies, target / source size. Its copies are the integers that the running
sum of expected copies, moved by one random offset per source, passes at the
document: over a source they add up to the whole within one, and documents of
like size stand next to each other, so that their words come near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart.llm.common import word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
#: Rows of a source that are sorted in one task.
STRETCH = 4_096


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, docs, source_size, target) from rows (source, size).

    Sources by code point, null last, take the weights in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's
    size and the excess is shared again by weight. That is one level L with
    target = min(most * size, L * weight): in the order of most * size / weight
    the full sources come first, and L is what the rest has by weight once the
    full ones are paid. One row for each source passes through one task.
    """
    sums = sized.groupBy("source").agg(F.count("*").alias("docs"),
                                       F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    full = sums.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(most))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = full.select(
        "*",
        ((F.lit(share) * F.sum("source_size").over(everything)
          - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
         / F.sum("weight").over(after)).alias("level"))
    # The first source that its share does not fill sets the level for all after it; the levels
    # that those would set are lower.
    open_ = F.col("most") >= F.col("level") * F.col("weight")
    highest = F.max(F.when(open_, F.col("level")))
    settled = level.withColumn("settled", highest.over(everything))
    return settled.select(
        "source", "docs", "source_size",
        F.coalesce(F.least("most", F.col("settled") * F.col("weight")), "most").alias("target"))


def _fraction(text: Column) -> Column:
    """A number in [0, 1) with 20 bits from the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken.

    ``size`` (the number of words unless given) counts a null or blank text as
    zero; such a document still takes its turn. A source is dealt into
    stretches of about ``stretch`` rows by the md5 of the doc_id, each sorted
    by size, so that no task sorts a whole source; what stands before a
    stretch is a sum over counts. Rows that agree in source, size and doc_id
    can stand in for each other. Null sources are one source. Columns of
    ``docs`` that have the name of a new one are replaced. Empty in, empty out.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in new]
    return copied(docs, **options).select(*kept, *new)


def copied(docs: DataFrame, seed: str = "mix", stretch: int = STRETCH, size: Column | None = None,
           weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
           most: float = MOST) -> DataFrame:
    """The documents of ``docs`` as structs ``row``, with the columns that ``mix`` adds."""
    sized = docs.select(F.struct("*").alias("row"), "doc_id", "source",
                        (word_count(F.col("text")) if size is None else size).alias("size"))
    targets = source_targets(sized, weights, share, most)
    named = targets.select(F.col("source").alias("t_source"), "docs", "source_size", "target")
    joined = sized.join(named, sized["source"].eqNullSafe(named["t_source"])).drop("t_source")
    stretches = F.ceil(F.col("docs") / stretch)
    deal = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8),
                  16, 10).cast("long") % stretches
    dealt = joined.withColumn("stretch", deal)
    counts = dealt.groupBy("source", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("c_source"), F.col("stretch").alias("c_stretch"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("source", "stretch").orderBy("size", "doc_id")
    ranked = dealt.withColumn("inside", F.row_number().over(inside))
    placed = ranked.join(counts, ranked["source"].eqNullSafe(counts["c_source"])
                         & (ranked["stretch"] == counts["c_stretch"]))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _fraction(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))))
    nth = F.col("earlier") + F.col("inside")
    copies = F.floor(nth * each + offset) - F.floor((nth - 1) * each + offset)
    return placed.withColumn("copies", copies).select(
        "row", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, each as often as it has copies, with the columns of
    ``docs``.

    Null texts have no words, and a null source is one like others. Whole texts
    count, however long; repeated rows are each dealt with. Empty in, empty out.
    """
    taken = copied(docs, **options).filter("copies > 0")
    repeated = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return taken.select("row", repeated.alias("copy")).select("row.*")
