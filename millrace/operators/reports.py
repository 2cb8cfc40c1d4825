"""Small reports over result tables: counts, look-ups and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.schemas import CLOCK_FORMAT, EVENT_TIME_FORMAT
from millrace.session import SHUFFLE_PARTITIONS_CONF

CUT_ACCURACY = 100_000  # ranks of the cuts are right to this part of all rows


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row frame."""
    return df.agg(F.count("*").alias("n_rows"))


def peek(df: DataFrame, rows: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """A few rows: any of them, or the first by ``order`` (each task keeps only its own first)."""
    return (df.orderBy(*order) if order else df).limit(rows)


def total_with_prefix(counts: DataFrame, prefix: str) -> DataFrame:
    """Sum of the counts of all words that begin with ``prefix``."""
    starts = F.substring("word", 1, len(prefix)) == prefix
    return counts.where(starts).agg(F.sum("count").alias("total"))


def window_rows(summary: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of the window whose bounds print as the given times, to the second.

    Asked as ranges of the bounds themselves, which a Parquet scan can use to skip row groups.
    """
    second = F.expr("INTERVAL 1 SECOND")
    conditions = F.lit(True)
    for name, text in (("start", start), ("end", end)):
        at = F.to_timestamp(F.lit(text), EVENT_TIME_FORMAT)
        conditions &= (F.col(name) >= at) & (F.col(name) < at + second)
    return summary.where(conditions)


def running_totals(
    df: DataFrame,
    columns: Sequence[str],
    order: str = "end",
    partition_by: Sequence[str] = (),
    bucket: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Running sums of ``columns`` by time, one row per time (and partition).

    Rows of equal time are peers and count together, as in the default frame of an ordered
    window; null times come first. A plain ordered window without partitions would bring every row
    to one task. Here the time axis is cut into ``slices`` ranges that hold equally many rows (by
    default as many as the session has shuffle partitions), rows run inside their range in
    parallel, only the totals of the ranges pass through an un-partitioned window, at most one row
    per range, and each range's opening balance is joined back to its rows.

    ``bucket``, a unit such as ``"day"``, keeps the rows of one unit in one range.
    """
    spark = df.sparkSession
    count = slices or int(spark.conf.get(SHUFFLE_PARTITIONS_CONF))
    at = F.date_trunc(bucket, order) if bucket else F.col(order)
    shares = [i / count for i in range(count)]
    cuts = df.agg(F.percentile_approx(at, shares, CUT_ACCURACY)).scalar()
    number = F.size(F.filter("_cuts", lambda cut: cut <= at))
    keys = [*partition_by, "_slice"]
    points = (
        df.groupBy(*partition_by, order)
        .agg(*[F.sum(name).alias(name) for name in columns])
        .withColumn("_cuts", F.array_distinct(cuts))
        .withColumn("_slice", number)
        .drop("_cuts")
    )
    inside = Window.partitionBy(*keys).orderBy(order)
    local = points.withColumns({name: F.sum(name).over(inside) for name in columns})

    before = Window.partitionBy(*partition_by).orderBy("_slice")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        points.groupBy(*keys)
        .agg(*[F.sum(name).alias(name) for name in columns])
        .select(*keys, *[F.sum(name).over(before).alias(f"_open_{name}") for name in columns])
    )
    if not partition_by:  # one row per range
        opening = F.broadcast(opening)
    same = F.lit(True)
    for name in keys:
        same &= F.col(f"l.{name}").eqNullSafe(F.col(f"o.{name}"))
    joined = local.alias("l").join(opening.alias("o"), same, "left")
    # A sum is null only while nothing but nulls has been seen.
    totals = {
        name: F.coalesce(F.col(name) + F.col(f"_open_{name}"), F.col(name), F.col(f"_open_{name}"))
        for name in columns
    }
    carried = [F.col(f"l.{name}").alias(name) for name in partition_by]
    return joined.select(
        *carried, F.col(f"l.{order}").alias(order), *[c.alias(n) for n, c in totals.items()]
    )


def running_net(
    summary: DataFrame, partition_by: Sequence[str] = (), bucket: str | None = None
) -> DataFrame:
    """Running bought, sold and net position by window end, labelled with the clock time."""
    totals = running_totals(summary, ["TotalBuy", "TotalSell"], "end", partition_by, bucket)
    report = totals.select(
        *partition_by,
        "end",
        F.date_format("end", CLOCK_FORMAT).alias("at_time"),
        F.col("TotalBuy").alias("Buy"),
        F.col("TotalSell").alias("Sell"),
    )
    return report.withColumn("Net", F.col("Buy") - F.col("Sell"))
