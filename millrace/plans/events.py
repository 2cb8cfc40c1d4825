"""Event-time summaries of a message log. ``log`` is a stream with ``key`` and ``value``.

Three ways to keep a summary: the whole of it after each batch (complete), the windows that a batch
changed, to be upserted (updated), and each window once, when it is closed. Complete mode counts
every late row and keeps all windows as state; the other two drop rows of windows that the
watermark has passed and free the state of those windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import (
    checked_log,
    running_net,
    sensor_maximum,
    sensor_readings,
    trade_columns,
    trade_summary,
    trades,
    window_aggregate,
)
from millrace.operators.logs import MALFORMED
from millrace.schemas import SENSOR, TRADE, WATERMARK_DELAY, WINDOW_SIZE
from millrace.streaming import UpsertStore, append, changed_groups, complete, observed
from millrace.streaming.sinks import BatchFunction


def trade_summary_stream(
    log: DataFrame,
    save: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str | None = WATERMARK_DELAY,
    schema: str = TRADE,
    name: str | None = "trade-summary",
) -> StreamingQuery:
    """Bought and sold amounts of all windows after every batch, late trades included."""
    summary = trade_summary(trades(log, schema), size, slide, watermark)
    return complete(summary, save, checkpoint, trigger, name)


def sensor_maximum_stream(
    log: DataFrame,
    save: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str | None = WATERMARK_DELAY,
    schema: str = SENSOR,
    name: str | None = "sensor-maximum",
) -> StreamingQuery:
    """Highest readings of all windows after every batch, late readings included."""
    summary = sensor_maximum(sensor_readings(log, schema), size, slide, watermark)
    return complete(summary, save, checkpoint, trigger, name)


def window_store(root: str, keys: Sequence[str] = (), **options) -> UpsertStore:
    """Target of updated windows: by key and start, in parts by the day of the start.

    The day is counted from the epoch and so does not move with the session's time zone.
    """
    day = F.floor(F.unix_seconds("start") / 86400)
    return UpsertStore(root, [*keys, "start"], "replace", part=day, **options)


def updated_windows(
    rows: DataFrame,
    aggregates: Sequence[Column],
    apply: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    keys: Sequence[str] = (),
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str = WATERMARK_DELAY,
    name: str | None = None,
) -> StreamingQuery:
    """Hand the windows that a batch changed to ``apply``, whole, to replace what they were.

    A late row changes its window as long as the watermark has not passed the window's end. Later
    ones are dropped.
    """
    windows = window_aggregate(
        rows, aggregates, size=size, slide=slide, keys=keys, watermark=watermark
    )
    return changed_groups(windows, apply, checkpoint, trigger, name)


def updated_trade_windows(
    log: DataFrame,
    apply: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str = WATERMARK_DELAY,
    schema: str = TRADE,
    name: str | None = "updated-trade-windows",
) -> StreamingQuery:
    """Bought and sold amounts of the windows that a batch changed, for a ``window_store(root)``."""
    summary = trade_summary(trades(log, schema), size, slide, watermark)
    return changed_groups(summary, apply, checkpoint, trigger, name)


def updated_sensor_windows(
    log: DataFrame,
    apply: BatchFunction,
    checkpoint: str,
    trigger: str | None = None,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str = WATERMARK_DELAY,
    schema: str = SENSOR,
    name: str | None = "updated-sensor-windows",
) -> StreamingQuery:
    """Highest readings of the sensors' windows that a batch changed.

    For a ``window_store(root, ["SensorID"])``.
    """
    summary = sensor_maximum(sensor_readings(log, schema), size, slide, watermark)
    return changed_groups(summary, apply, checkpoint, trigger, name)


def closed_trade_windows(
    log: DataFrame,
    checkpoint: str,
    table: str = "trade_windows",
    trigger: str | None = None,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str = WATERMARK_DELAY,
    path: str | None = None,
    schema: str = TRADE,
    name: str | None = "closed-trade-windows",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Bought and sold amounts of each window once, when the watermark has passed its end."""
    summary = trade_summary(trades(log, schema), size, slide, watermark)
    return append(summary, table, checkpoint, trigger, name, path, fmt)


def closed_sensor_windows(
    log: DataFrame,
    checkpoint: str,
    table: str = "sensor_windows",
    trigger: str | None = None,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str = WATERMARK_DELAY,
    path: str | None = None,
    schema: str = SENSOR,
    name: str | None = "closed-sensor-windows",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Highest readings of each window once, when the watermark has passed its end.

    State of closed windows is freed and readings later than the watermark are dropped, which is
    what keeps an endless stream bounded.
    """
    summary = sensor_maximum(sensor_readings(log, schema), size, slide, watermark)
    return append(summary, table, checkpoint, trigger, name, path, fmt)


def observed_trades(log: DataFrame, schema: str = TRADE, name: str = "trades") -> DataFrame:
    """The well-formed trades of a log, which counts its rows as they pass.

    The counts come to a ``Metrics`` listener under ``name``: ``rows_in`` are all records,
    ``malformed`` those left out because their payload does not fit, and ``untimed`` those whose
    text is no time, which are in no window.
    """
    rows = checked_log(log.withColumns(_missing(log)), schema)
    bad = F.col(MALFORMED).isNotNull()
    times = trade_columns(rows.select(MALFORMED, F.inline(F.array("value"))))
    untimed = F.count_if(~bad & F.col("CreatedTime").isNull())
    seen = observed(
        times, name, rows_in=F.count(F.lit(1)), malformed=F.count_if(bad), untimed=untimed
    )
    return seen.where(~bad).drop(MALFORMED)


def _missing(log: DataFrame) -> dict[str, Column]:
    """Envelope columns that a stored log table lacks."""
    kinds = {"topic": "string", "timestamp": "timestamp"}
    return {n: F.lit(None).cast(t) for n, t in kinds.items() if n not in log.columns}


def net_position_report(summary: DataFrame) -> DataFrame:
    """Running bought, sold and net position over a stored trade summary."""
    return running_net(summary)
