"""Rows that every operator has to take, and brute-force helpers."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; here they are columns of the input.
EXTRA = ("row string, key string, nth string, size string, taken string, copies string, "
         "docs string, target string, kept string, recipe string, node string, fp string, "
         "held_out string, score string, text_sha256 string, h string, d string, spans string")


def awkward(spark, extra: bool = True):
    """Nulls in any column, empty, blank and very long texts, repeated rows and ids."""
    texts = [
        (1, "The cat sat on the mat and looked at the dog for a while today.", "en", "a"),
        (2, "THE CAT sat on the mat and looked at the dog for a while today.", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, " \n\t ", None, "b"),
        (6, "word " * 30_000, "en", None), (7, "x" * 100_000, None, "c"),
        (8, "naïve café 日本語 🙂 <|endoftext|> it's a test\x00.", "fr", "c"),
        (8, "another text with the same id as the one before it, nothing more.", "fr", "c"),
        (None, "a row without an id but with a text of some words in it, ten at least", "de", "a"),
        (1, "The cat sat on the mat and looked at the dog for a while today.", "en", "a"),
    ]
    rows = [(i, t, lang, source, None) for i, t, lang, source in texts]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for column in EXTRA.split(", "):
            df = df.selectExpr("*", f"'x' as {column.split()[0]}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")
