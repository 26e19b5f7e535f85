"""Casts, text and date clean-up, fills and scalar features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A whole number written with a fraction, such as 3.7 or 45.0.
DECIMAL_TAIL = r"^(\s*[+-]?\d+)\.\d*\s*$"
WHOLE_TYPES = {"int", "bigint"}
# A number in decimal notation; Spark's cast alone would also take 1d, 2f and 0x1p3.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lenient_cast(value: Column, target: str, truncate_decimals: bool = False) -> Column:
    """Cast that yields NULL for text that does not convert.

    ``truncate_decimals`` accepts 45.0 for a whole-number target by cutting the
    fraction; by default such text is NULL.
    """
    if truncate_decimals and target in WHOLE_TYPES:
        value = F.regexp_replace(value.cast("string"), DECIMAL_TAIL, "$1")
    return value.try_cast(target)


def cast_columns(
    df: DataFrame, types: Mapping[str, str], truncate_decimals: bool = False
) -> DataFrame:
    """Leniently cast the named columns that exist."""
    present = {name: target for name, target in types.items() if name in df.columns}
    return df.withColumns({
        name: lenient_cast(F.col(f"`{name}`"), target, truncate_decimals)
        for name, target in present.items()
    })


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select([F.col(f"`{name}`") for name in columns if name in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_flag(df: DataFrame, name: str, value: int = 1) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def percent_to_fraction(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Replace each 0-100 column by a 0-1 column under its new name."""
    present = {old: new for old, new in names.items() if old in df.columns}
    scaled = df.withColumns({
        new: F.col(f"`{old}`").try_cast("float") / F.lit(100.0) for old, new in present.items()
    })
    return scaled.drop(*present)


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns if c in df.columns})


def normalized(value: Column) -> Column:
    """Lower case without surrounding spaces."""
    return F.trim(F.lower(value))


def normalize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: normalized(F.col(c)) for c in columns if c in df.columns})


def normalize_key(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, normalized(F.col(source)))


def parse_release_date(df: DataFrame, column: str = "release_date") -> DataFrame:
    """Text like ``2015-06-09 00:00:00 UTC`` to a timestamp, its month and year."""
    text = F.regexp_replace(F.col(column), " UTC$", "")
    parsed = df.withColumn(column, F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))
    return parsed.withColumns({
        "release_month": F.month(column),
        "release_year": F.year(column),
    })


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna({name: value for name, value in values.items() if name in df.columns})


def coalesce_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whole-number columns with 0 for NULL or unreadable values."""
    return df.withColumns({
        c: F.coalesce(F.col(c).try_cast("bigint"), F.lit(0).cast("bigint")) for c in columns
    })


def with_log1p(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.log1p(F.col(source).cast("double")))


def number_text(value: Column) -> Column:
    """The text of a value that is a number in decimal notation, else NULL."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), text)


def whole_number(value: Column, target: str) -> Column:
    """Text to a whole number, 1234.0 and 1.2e5 included; a fraction is cut.

    Digits alone are not sent through a double, which would round large ones.
    """
    number = number_text(value)
    return F.coalesce(number.try_cast(target), number.try_cast("double").try_cast(target))


def safe_int(value: Column, default: int = 0) -> Column:
    """Text to a whole number by way of a double, cut toward zero."""
    return F.coalesce(number_text(value).try_cast("double").try_cast("int"), F.lit(default))


def safe_long(value: Column, default: int = 0) -> Column:
    return F.coalesce(whole_number(value, "bigint"), F.lit(default).cast("bigint"))


def safe_float(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(number_text(value).try_cast("double"), F.lit(float(default)))


def clamp_play_duration(played: Column, duration: Column, floor_ms: int = 30000) -> Column:
    """Listened time kept between the floor (or a shorter track) and the track length."""
    lowest = F.least(F.lit(floor_ms).cast("bigint"), duration)
    return F.least(F.greatest(played, lowest), duration)
