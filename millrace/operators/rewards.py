"""Reward totals per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import exact_money
from millrace.schemas import POINTS_RATE


def rewards(
    invoices: DataFrame,
    key: str = "CustomerCardNo",
    amount: str = "TotalAmount",
    rate: str = POINTS_RATE,
    exact: bool = False,
) -> DataFrame:
    """Total amount and points per customer, summed map-side before the one shuffle.

    Doubles by default. ``exact=True`` sums whole cents as decimals, which gives the same total
    whatever the order of rows, batches and retries.
    """
    value = exact_money(amount) if exact else F.col(amount)
    factor = F.expr(f"{rate}" if exact else f"{rate}D")
    return invoices.groupBy(key).agg(
        F.sum(value).alias("TotalAmount"), F.sum(value * factor).alias("TotalPoints")
    )


def as_double(df: DataFrame, columns: Sequence[str] = ("TotalAmount", "TotalPoints")) -> DataFrame:
    """The given columns as doubles, for readers of exact totals."""
    return df.withColumns({name: F.col(name).cast("double") for name in columns})
