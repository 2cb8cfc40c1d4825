"""Word counts from text files, as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import tokens, word_count
from millrace.schemas import SENTENCE_SEPARATOR, WORD_SEPARATOR
from millrace.sources import sentences
from millrace.streaming import complete, overwrite_table
from millrace.streaming.sinks import BatchFunction


def word_count_table(
    spark: SparkSession,
    text: str,
    table: str = "word_counts",
    path: str | None = None,
    separator: str = SENTENCE_SEPARATOR,
    pattern: str = WORD_SEPARATOR,
    fmt: str = "parquet",
) -> None:
    """Count the words of the text files under ``text`` and replace ``table`` by the counts."""
    counts = word_count(tokens(sentences(spark, text, separator=separator), pattern=pattern))
    overwrite_table(counts, table, path, fmt)


def word_count_stream(
    spark: SparkSession,
    text: str,
    save: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    max_files: int | None = None,
    separator: str = SENTENCE_SEPARATOR,
    pattern: str = WORD_SEPARATOR,
    max_bytes: int | None = None,
    name: str | None = "word-count",
) -> StreamingQuery:
    """Hand the counts of all words seen so far to ``save`` after every batch."""
    lines = sentences(
        spark, text, stream=True, separator=separator, max_files=max_files, max_bytes=max_bytes
    )
    counts = word_count(tokens(lines, pattern=pattern))
    return complete(counts, save, checkpoint, trigger, name)
