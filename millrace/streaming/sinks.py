"""Write modes of a batch or a stream. Every stream takes its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchFunction = Callable[[DataFrame, int], None]

# Drain what is there in rate-limited batches, then stop.
DRAIN = "batch"


def _writer(
    df: DataFrame, mode: str, checkpoint: str, trigger: str | None, name: str | None
) -> DataStreamWriter:
    """``trigger`` is ``"batch"`` to drain and stop, an interval such as ``"60 seconds"``, or
    None to start each batch when the one before is done."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger == DRAIN:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def overwrite_table(
    df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet"
) -> None:
    """Replace the whole of a catalog table by a batch result."""
    writer = df.write.format(fmt).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def table_saver(table: str, path: str | None = None, fmt: str = "parquet") -> BatchFunction:
    """A function for ``complete`` that replaces a catalog table by the result of each batch.

    Readers may find the table empty while it is replaced; with ``Snapshots`` they do not.
    """

    def save(df: DataFrame, batch_id: int) -> None:
        overwrite_table(df, table, path, fmt)

    return save


def append(
    df: DataFrame,
    table: str,
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Add the rows of a stream to a catalog table, each exactly once."""
    writer = _writer(df, "append", checkpoint, trigger, name).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (writer.option("path", path) if path else writer).toTable(table)


def complete(
    df: DataFrame,
    save: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand the whole result to ``save`` after every batch, e.g. ``Snapshots(...).save``."""
    return _writer(df, "complete", checkpoint, trigger, name).foreachBatch(save).start()


def changed_groups(
    df: DataFrame,
    apply: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand only the groups that a batch changed to ``apply``."""
    return _writer(df, "update", checkpoint, trigger, name).foreachBatch(apply).start()


def raw_batches(
    df: DataFrame,
    apply: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand the new rows of a stream to ``apply``; the stream itself keeps no state."""
    return _writer(df, "append", checkpoint, trigger, name).foreachBatch(apply).start()
