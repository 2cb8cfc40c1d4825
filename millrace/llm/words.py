"""Words of whole texts as Spark columns: runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The words in order, an empty array for a null text or one without words."""
    inner = F.btrim(text, F.lit(WHITE))
    empty = F.array().cast("array<string>")
    return F.when(F.length(inner) > 0, F.split(inner, r"[\x20\x09-\x0D]+")).otherwise(empty)


def word_count(text: Column) -> Column:
    """Number of words, without gathering them; 0 for a null text."""
    inner = F.btrim(text, F.lit(WHITE))
    gaps = F.size(F.split(inner, r"[\x20\x09-\x0D]+"))
    return F.when(F.length(inner) > 0, gaps).otherwise(0).cast("bigint")


def without(text: Column, chars: str) -> Column:
    """The text without some characters; empty for a null text."""
    return F.translate(F.coalesce(text, F.lit("")), chars, "")
