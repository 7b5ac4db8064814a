"""Words of a text, and how often each occurs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_words(text: Column) -> Column:
    """Split at single spaces. Leading and inner empty words stay, trailing ones go; '' gives one empty word."""
    kept = F.rtrim(text)
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, " "))
    )


def words(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per word, in a single column ``value``."""
    return lines.select(F.explode(split_words(F.col(column))).alias("value"))


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of each word. On a stream this is a running count."""
    return words(lines, column).groupBy("value").count()
