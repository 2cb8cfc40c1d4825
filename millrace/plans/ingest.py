"""Ingest of a message log into a raw table. ``log`` is any stream of envelope rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import checked_log, decode_log, distinct_records
from millrace.operators.logs import MALFORMED, RECORD_KEY
from millrace.schemas import INVOICE
from millrace.streaming import UpsertStore, append, raw_batches
from millrace.streaming.sinks import BatchFunction


def ingest_log(
    log: DataFrame,
    checkpoint: str,
    table: str = "log_records",
    schema: str = INVOICE,
    trigger: str | None = None,
    path: str | None = None,
    name: str | None = "log-ingest",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append decoded records to ``table``. A record delivered twice is there twice."""
    return append(decode_log(log, schema), table, checkpoint, trigger, name, path, fmt)


def ingest_checked(
    log: DataFrame,
    checkpoint: str,
    table: str = "checked_records",
    schema: str = INVOICE,
    trigger: str | None = None,
    path: str | None = None,
    name: str | None = "checked-log-ingest",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append decoded records to ``table`` with malformed ones set apart, from one parse.

    The table is partitioned by ``side``, ``good`` or ``bad``, so either is read without the other.
    A bad record has its payload in ``malformed``.
    """
    rows = checked_log(log, schema, keep=["offset"])
    side = F.when(F.col(MALFORMED).isNull(), "good").otherwise("bad")
    sides = rows.withColumn("side", side)
    return append(sides, table, checkpoint, trigger, name, path, fmt, partition_by=["side"])


def idempotent_store(root: str, roll_up_every: int = 20, **options) -> UpsertStore:
    """Raw records by payload and time, in parts by day. A record delivered again replaces.

    The day is counted from the epoch and so does not move with the session's time zone.
    """
    day = F.floor(F.unix_seconds("timestamp") / 86400)
    return UpsertStore(root, RECORD_KEY, part=day, roll_up_every=roll_up_every, **options)


def ingest_idempotent(
    log: DataFrame,
    apply: BatchFunction,
    checkpoint: str,
    schema: str = INVOICE,
    trigger: str | None = None,
    name: str | None = "idempotent-log-ingest",
) -> StreamingQuery:
    """Hand the distinct records of each batch to ``apply`` to be upserted by ``RECORD_KEY``.

    With ``idempotent_store(root).apply`` each record is kept once however often it is delivered.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        apply(distinct_records(batch, schema), batch_id)

    return raw_batches(log, fold, checkpoint, trigger, name)
