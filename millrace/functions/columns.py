"""Column expressions used by more than one operator; all built of JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import EVENT_TIME_FORMAT, WORD_PATTERN

EXACT_MONEY = "decimal(28,6)"


def clean_word(word: str | Column) -> Column:
    """Lower-cased word without surrounding spaces. Other white space stays."""
    return F.lower(F.trim(word))


def is_word(word: str | Column) -> Column:
    """True for text with a latin letter in it; false for null."""
    word = F.col(word) if isinstance(word, str) else word
    return word.isNotNull() & word.rlike(WORD_PATTERN)


def event_time(text: str | Column, pattern: str = EVENT_TIME_FORMAT) -> Column:
    """Timestamp read from text, null where the text does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def decode_json(payload: str | Column, schema: T.StructType | str) -> Column:
    """Struct read from a string or binary JSON payload; a malformed one has all fields null."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(payload.cast("string"), schema)


def exact_money(amount: str | Column) -> Column:
    """Amount as a decimal, exact to a millionth and up to 10 ** 22.

    Sums of it do not depend on the order in which partitions arrive; sums of doubles do. A larger
    amount is an error under Spark's default ANSI mode, not a wrong sum.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    return amount.cast(EXACT_MONEY)
