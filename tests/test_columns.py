import math

import pytest
from pyspark.sql import functions as F
from table_rows import rows

from trackmart.functions import columns as C


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_bad_text_becomes_null(spark):
    df = texts(spark, "abc", "3.7", " 12 ", "", "1,021", "99999999999", None)
    cast = C.cast_columns(df, {"x": "int", "absent": "int"})
    assert [r[0] for r in cast.collect()] == [None, None, 12, None, None, None, None]


def test_decimals_can_be_cut_instead(spark):
    df = texts(spark, "3.7", "-3.7", "45.0", "7", "1e3", "abc", None)
    cast = C.cast_columns(df, {"x": "int"}, truncate_decimals=True)
    assert [r[0] for r in cast.collect()] == [3, -3, 45, 7, None, None, None]


def test_float_cast(spark):
    cast = C.cast_columns(texts(spark, "0.5", "x", "NaN"), {"x": "float"}).collect()
    assert cast[0][0] == 0.5 and cast[1][0] is None and math.isnan(cast[2][0])


def test_select_existing_keeps_listed_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.select_existing(df, ["b", "z", "a"]).columns == ["b", "a"]


def test_rename_with_parentheses(spark):
    df = spark.createDataFrame([("x",)], "`artist(s)_name` string")
    assert C.rename(df, {"artist(s)_name": "artist_name"}).columns == ["artist_name"]


def test_percentages(spark):
    df = spark.createDataFrame([("80",), ("abc",), (None,)], "`energy_%` string")
    out = C.percent_to_fraction(df, {"energy_%": "energy", "valence_%": "valence"})
    assert out.dtypes == [("energy", "double")]
    assert [r[0] for r in out.collect()] == [0.8, None, None]


def test_trim_keeps_tabs_and_accents(spark):
    df = texts(spark, "  Beyoncé ", "\tTab\t", None)
    assert [r[0] for r in C.trim_columns(df, ["x"]).collect()] == ["Beyoncé", "\tTab\t", None]
    assert [r[0] for r in C.normalize_text(df, ["x"]).collect()] == ["beyoncé", "\ttab\t", None]
    keyed = C.normalize_key(df, "x", "k").select("k").collect()
    assert keyed[0][0] == "beyoncé"


def test_release_dates(spark):
    df = texts(spark, "2015-06-09 00:00:00 UTC", "2015-06-09 10:30:00", "2015-06", None)
    out = C.parse_release_date(df.withColumnRenamed("x", "release_date"))
    assert [(r.release_month, r.release_year) for r in out.collect()] == [
        (6, 2015), (6, 2015), (None, None), (None, None)
    ]


def test_log_and_zero(spark):
    df = spark.createDataFrame([(0,), (None,), (9,)], "followers long")
    logged = C.with_log1p(df, "followers", "l").select("l").collect()
    assert logged[0][0] == 0.0 and logged[1][0] is None
    assert logged[2][0] == pytest.approx(math.log(10))
    zeroed = C.coalesce_zero(texts(spark, "5", "x", None), ["x"])
    assert [r[0] for r in zeroed.collect()] == [5, 0, 0]


def test_fill_skips_absent_columns(spark):
    filled = C.fill_nulls(texts(spark, None, "a"), {"x": "unknown", "absent": 1})
    assert [r[0] for r in filled.collect()] == ["unknown", "a"]


def test_numbers_are_in_decimal_notation(spark):
    df = texts(spark, "1d", "2f", "0x1p3", " 1.5e2 ", "+.5", "9007199254740993")
    out = df.select(C.safe_long(F.col("x"), -1), C.safe_float(F.col("x"), -1.0))
    assert [tuple(r) for r in out.collect()] == [
        (-1, -1.0), (-1, -1.0), (-1, -1.0), (150, 150.0), (0, 0.5),
        (9007199254740993, 9007199254740992.0)]


def test_safe_conversions(spark):
    df = texts(spark, "3.7", "-3.7", "abc", "", None, "12")
    out = df.select(C.safe_int(F.col("x"), 9), C.safe_float(F.col("x"), 0.5),
                    C.safe_long(F.col("x"), 7))
    assert [tuple(r) for r in out.collect()] == [
        (3, 3.7, 3), (-3, -3.7, -3), (9, 0.5, 7), (9, 0.5, 7), (9, 0.5, 7), (12, 12.0, 12)
    ]


def test_clamped_duration(spark):
    df = spark.createDataFrame(
        [(5000, 20000), (10, 200000), (500000, 200000), (60000, 200000)], "p long, d long"
    )
    out = df.select(C.clamp_play_duration(F.col("p"), F.col("d")))
    assert [r[0] for r in out.collect()] == [20000, 30000, 200000, 60000]


def test_flag(spark):
    assert rows(C.with_flag(texts(spark, "a"), "is_chart_hit")) == [("a", 1)]
