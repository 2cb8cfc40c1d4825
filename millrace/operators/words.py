"""Words of a text column and their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import clean_word, is_word
from millrace.schemas import WORD_SEPARATOR


def tokens(
    df: DataFrame,
    column: str = "value",
    pattern: str = WORD_SEPARATOR,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One ``word`` row per piece of ``column`` that holds a latin letter.

    ``pattern`` is a regular expression. With the default, a single space, punctuation and line
    ends stay in the word; ``r"\\s+"`` cuts at any white space. ``keep`` names columns to carry.
    """
    pieces = df.select(*keep, F.explode(F.split(column, pattern)).alias("word"))
    return pieces.select(*keep, clean_word("word").alias("word")).where(is_word("word"))


def word_count(words: DataFrame) -> DataFrame:
    """Occurrences per word. Counted map-side first, so a frequent word is no hot key."""
    return words.groupBy("word").count()
