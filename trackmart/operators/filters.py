"""Row filters; NULL fails every predicate unless the name says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column (NaN counts as missing)."""
    return df.dropna(subset=list(columns))


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def at_least(df: DataFrame, column: str, low) -> DataFrame:
    return df.filter(F.col(column) >= low)


def in_range_or_null(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).isNull() | F.col(column).between(low, high))


def differs(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) != F.lit(value))


def require_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose listed text columns are present and not empty."""
    for column in columns:
        df = df.filter(F.col(column) != "")
    return df
