"""Customer rewards: raw invoices to a table, and three ways to keep totals over that table.

The three agree: whole result after each batch, changed totals that replace, and totals of each
batch alone that add up. The last keeps no stream state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import rewards
from millrace.sources import invoices, table, with_input_file
from millrace.streaming import UpsertStore, append, changed_groups, complete, raw_batches
from millrace.streaming.sinks import BatchFunction

CARD = ["CustomerCardNo"]
CARD_PARTS = 16


def bronze_invoices(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    table: str = "raw_invoices",
    trigger: str | None = None,
    max_files: int | None = None,
    path: str | None = None,
    max_bytes: int | None = None,
    name: str | None = "raw-invoices",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append new invoices as they come, each with the file it came from, to a raw table."""
    source = invoices(spark, landing, stream=True, max_files=max_files, max_bytes=max_bytes)
    return append(with_input_file(source), table, checkpoint, trigger, name, path, fmt)


def rewards_store(root: str, **options) -> UpsertStore:
    """Target of ``rewards_updated``: new totals replace old ones."""
    return UpsertStore(root, CARD, "replace", **(card_parts() | options))


def accumulate_store(root: str, **options) -> UpsertStore:
    """Target of ``rewards_accumulated``: totals of batches add up."""
    return UpsertStore(root, CARD, "accumulate", **(card_parts() | options))


def card_parts() -> dict:
    """Cards in parts by a hash, so that a read folds only the parts with recent changes."""
    return {"part": F.pmod(F.xxhash64("CustomerCardNo"), F.lit(CARD_PARTS))}


def rewards_complete(
    spark: SparkSession,
    bronze: str,
    save: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    max_files: int | None = None,
    exact: bool = False,
    max_bytes: int | None = None,
    name: str | None = "rewards-complete",
) -> StreamingQuery:
    """Totals of all customers, handed to ``save`` whole after every batch."""
    rows = table(spark, bronze, stream=True, max_files=max_files, max_bytes=max_bytes)
    totals = rewards(rows, exact=exact)
    return complete(totals, save, checkpoint, trigger, name)


def rewards_updated(
    spark: SparkSession,
    bronze: str,
    apply: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    max_files: int | None = None,
    exact: bool = False,
    max_bytes: int | None = None,
    name: str | None = "rewards-update",
) -> StreamingQuery:
    """Totals of the customers in each batch, handed to ``apply`` to replace the old ones."""
    rows = table(spark, bronze, stream=True, max_files=max_files, max_bytes=max_bytes)
    totals = rewards(rows, exact=exact)
    return changed_groups(totals, apply, checkpoint, trigger, name)


def rewards_accumulated(
    spark: SparkSession,
    bronze: str,
    apply: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    max_files: int | None = None,
    exact: bool = False,
    max_bytes: int | None = None,
    name: str | None = "rewards-accumulate",
) -> StreamingQuery:
    """What each batch alone adds per customer, handed to ``apply`` to be added up.

    A batch may be handed over again after a failure. ``UpsertStore.apply`` copes with that; a
    plain SQL merge would add it twice.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        apply(rewards(batch, exact=exact), batch_id)

    rows = table(spark, bronze, stream=True, max_files=max_files, max_bytes=max_bytes)
    return raw_batches(rows, add, checkpoint, trigger, name)
