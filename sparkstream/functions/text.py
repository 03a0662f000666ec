"""Text steps: tokens, word pairs, keyword filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkstream.plans.sizes import broadcast_if_small


def tokens(col: str | Column) -> Column:
    """Pieces between single spaces; inner empty pieces stay, trailing ones are dropped.

    An empty line has one empty piece, a line of nothing but spaces has none.
    """
    text = F.col(col) if isinstance(col, str) else col
    pieces = F.split(F.rtrim(text), " ")
    return F.when((F.rtrim(text) == "") & (text != ""), F.array().cast("array<string>")).otherwise(pieces)


def tokenize(df: DataFrame, col: str, out: str = "word") -> DataFrame:
    """One row per word of ``col``; the other columns are repeated."""
    return df.withColumn(out, F.explode(tokens(col)))


def pair_one(df: DataFrame, word: str = "word", out: str = "cnt") -> DataFrame:
    """``(word, 1)``."""
    return df.select(word, F.lit(1).alias(out))


def split_pairs(df: DataFrame, col: str, word: str = "word", out: str = "cnt") -> DataFrame:
    """Split and pair in one step."""
    return pair_one(tokenize(df, col, word), word, out)


def exclude(df: DataFrame, col: str, banned: Sequence[str] | DataFrame) -> DataFrame:
    """Drop rows whose ``col`` equals a banned word, given as a short list or a one-column DataFrame."""
    if isinstance(banned, DataFrame):
        words = banned.toDF(col).distinct()
        return df.join(broadcast_if_small(words), col, "left_anti")
    return df.where(F.col(col).isNull() | ~F.col(col).isin(*banned))


def keep_containing(df: DataFrame, col: str, needle: str) -> DataFrame:
    return df.where(F.col(col).contains(needle))


def has_match(df: DataFrame, col: str, regex: str) -> DataFrame:
    """Rows in which ``regex`` is found anywhere in ``col``."""
    return df.where(F.col(col).rlike(regex))


def has_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.where(F.substring(col, 1, len(prefix)) == prefix)


def format_pair(left: str, right: str, sep: str = ":::") -> Column:
    """``left<sep>right`` as text."""
    return F.concat_ws(sep, F.col(left).cast("string"), F.col(right).cast("string"))


def binary_text(col: str) -> Column:
    """An integer column written in base two."""
    return F.bin(col)
