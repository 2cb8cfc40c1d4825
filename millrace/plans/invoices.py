"""Invoice files to a table of line items."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import line_items
from millrace.sources import invoices
from millrace.streaming import append


def invoice_lines_stream(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    table: str = "line_items",
    trigger: str | None = "batch",
    max_files: int | None = None,
    path: str | None = None,
    max_bytes: int | None = None,
    name: str | None = "invoice-line-items",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append the line items of new invoice files to ``table``; a map-only stream.

    ``trigger="batch"`` drains the landing folder and stops; an interval keeps the query running.
    """
    source = invoices(spark, landing, stream=True, max_files=max_files, max_bytes=max_bytes)
    return append(line_items(source), table, checkpoint, trigger, name, path, fmt)
