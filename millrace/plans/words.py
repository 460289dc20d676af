"""Most used word and longest words of a text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import WORD, words
from millrace.operators.ranking import top_rows


def tokens(lines: DataFrame, column: str = "value", pattern: str = WORD) -> DataFrame:
    """One row per word as written."""
    return lines.select(F.explode(words(column, pattern)).alias("token"))


def word_counts(lines: DataFrame, column: str = "value", pattern: str = WORD) -> DataFrame:
    """How often each lower-cased word occurs."""
    return tokens(lines, column, pattern).groupBy(F.lower("token").alias("word")).agg(
        F.count(F.lit(1)).alias("occurrences")
    )


def most_used_word(lines: DataFrame, column: str = "value", pattern: str = WORD) -> DataFrame:
    """The most frequent word; of equally frequent ones the greatest."""
    return top_rows(word_counts(lines, column, pattern), 1, F.desc("occurrences"), F.desc("word"))


def longest_words(lines: DataFrame, top: int, column: str = "value", pattern: str = WORD) -> DataFrame:
    """The `top` longest distinct lower-cased words; equally long ones in alphabetical order."""
    distinct = (
        tokens(lines, column, pattern)
        .groupBy(F.lower("token").alias("word"))
        .agg(F.max(F.length("token")).alias("length"))
    )
    return top_rows(distinct, top, F.desc("length"), F.asc("word"))
