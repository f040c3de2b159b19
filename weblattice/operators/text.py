"""Tokenising and word counting (the word-count job).

Tokens are the pieces of a line split on single spaces with Java semantics:
case and punctuation are kept, inner empty tokens are kept, trailing ones are
dropped. The count is a plain grouped count: Spark plans it as a partial
(map-side) hash aggregate, an exchange on ``word`` and a final aggregate, so
a very frequent word is pre-summed inside every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import java_split, text_lines


def lines_from_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per line of a text column, as ``value`` (a file per row). How
    many tasks scan is the session's ``spark.sql.files.*`` settings' affair."""
    return df.select(F.explode(text_lines(F.col(text_col))).alias("value"))


def tokens(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row per token (``word``) of every line."""
    return lines.select(F.explode(java_split(F.col(col), " ")).alias("word"))


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(word, n)``: occurrences of every token."""
    return tokens(lines, col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def format_pairs(counts: DataFrame, key: str = "word", value: str = "n") -> DataFrame:
    """Render ``(key,value)`` text lines as ``value`` (the pair-text sink form)."""
    return counts.select(
        F.format_string("(%s,%d)", F.col(key), F.col(value)).alias("value"))
