"""Event-time window aggregates, the same on static frames and on streams."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import WATERMARK_DELAY, WINDOW_SIZE

MICROSECONDS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def window_aggregate(
    df: DataFrame,
    aggregates: Sequence[Column],
    time: str = "CreatedTime",
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    keys: Sequence[str] = (),
    watermark: str | None = WATERMARK_DELAY,
    combine: Sequence[Column] = (),
) -> DataFrame:
    """Aggregates per key and window, with the window's bounds as ``start`` and ``end``.

    Without ``slide`` windows do not overlap. Rows with a null time are in no window. The
    watermark only matters on a stream: it lets append and update modes drop late rows and
    free the state of closed windows. Names, not column objects of ``df``, are used after it,
    because those would not carry the watermark.

    Windows that overlap would take a copy of every row each. If ``combine`` says how results of
    ``aggregates`` over parts of a window add up to that of the whole, as with sums and maxima, a
    static frame is first aggregated to panes, the stretches that every window is made of, and
    only panes are copied. A stream keeps the plain form, in which a late row still counts in
    those of its windows that are open.
    """
    if watermark is not None and df.isStreaming:
        df = df.withWatermark(time, watermark)
    pane = pane_length(size, slide) if combine and slide and not df.isStreaming else None
    if pane is None:
        window = F.window(F.col(time), size, slide)
        grouped = df.groupBy(*keys, window.alias("window")).agg(*aggregates)
    else:
        panes = df.groupBy(*keys, F.window(F.col(time), pane).alias("pane")).agg(*aggregates)
        window = F.window(F.col("pane"), size, slide)
        grouped = panes.groupBy(*keys, window.alias("window")).agg(*combine)
    values = [name for name in grouped.columns if name not in (*keys, "window")]
    return grouped.select(*keys, "window.start", "window.end", *values)


def pane_length(size: str, slide: str) -> str | None:
    """The longest stretch that windows of this size and slide begin and end at multiples of.

    None if windows do not overlap, or if an interval is not written as numbers and fixed units.
    """
    lengths = [microseconds(size), microseconds(slide)]
    if None in lengths or lengths[0] <= lengths[1]:
        return None
    return f"{gcd(*lengths)} microseconds"


def microseconds(interval: str) -> int | None:
    """Length of an interval such as ``"1 hour 30 minutes"``; None if it has other words in it."""
    words = interval.lower().split()
    if words[:1] == ["interval"]:
        words = words[1:]
    if not words or len(words) % 2:
        return None
    total = 0
    for number, unit in zip(words[::2], words[1::2]):
        length = MICROSECONDS.get(unit.removesuffix("s"))
        if length is None or not number.isdecimal():
            return None
        total += int(number) * length
    return total or None


def trade_summary(
    trades: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str | None = WATERMARK_DELAY,
) -> DataFrame:
    """Bought and sold amounts per window."""
    totals = [F.sum("Buy").alias("TotalBuy"), F.sum("Sell").alias("TotalSell")]
    sums = [F.sum(name).alias(name) for name in ("TotalBuy", "TotalSell")]
    return window_aggregate(
        trades, totals, size=size, slide=slide, watermark=watermark, combine=sums
    )


def sensor_maximum(
    readings: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    watermark: str | None = WATERMARK_DELAY,
) -> DataFrame:
    """Highest reading per sensor and window."""
    highest = [F.max("Reading").alias("MaxReading")]
    return window_aggregate(
        readings,
        highest,
        size=size,
        slide=slide,
        keys=["SensorID"],
        watermark=watermark,
        combine=[F.max("MaxReading").alias("MaxReading")],
    )
