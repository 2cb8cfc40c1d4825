"""Gathering of rows into the documents they belong to, whatever their number per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_ROWS = 8192
BROADCAST_KEYS = 1 << 20  # long keys up to which their list is broadcast, some 20 MB
SALTS = 64


def nested(
    headers: DataFrame,
    rows: DataFrame,
    key: str,
    item: Column,
    items: str = "items",
    page: str = "page",
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Headers with their rows, as ``item``, in an array; long ones in several pages.

    A key with up to ``page_rows`` rows makes one document, numbered 1. The rows of a key with more
    are dealt over pages before they are shuffled, by a hash of their place in the scan, so that
    they go to as many tasks as there are pages and no array outgrows a page: pages are filled to
    half on average, and equal rows are dealt like others. Each page repeats the header. Headers
    without rows and rows without a header or a key give nothing.

    Long keys are found by a count of the key column alone. ``rows`` must come straight from files,
    where a lost task that runs again numbers its rows as before.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    pages = F.ceil(F.col("_n") / (page_rows / 2)).cast("bigint").alias("_pages")
    long = counts.where(F.col("_n") > page_rows).select(key, pages)
    n_long = long.count()

    place = F.xxhash64(F.monotonically_increasing_id())
    placed = rows.select(key, place.alias("_place"), item.alias("_item"))
    placed = placed.where(F.col(key).isNotNull())
    if n_long == 0:  # nothing to deal: rows meet their header where they are gathered
        documents = placed.groupBy(key).agg(F.collect_list("_item").alias(items))
        whole = documents.join(headers, key)
        return whole.select(*headers.columns, F.lit(1).cast("bigint").alias(page), items)

    one = F.lit(1).cast("bigint")
    dealt = _with_pages(placed, long, key, n_long)
    dealt = dealt.withColumn(page, F.coalesce(one + F.pmod("_place", F.col("_pages")), one))
    documents = dealt.groupBy(key, page).agg(F.collect_list("_item").alias(items))
    marked = headers.withColumn("_place", F.xxhash64(key))
    numbers = F.explode(F.sequence(one, F.coalesce("_pages", one)))
    repeated = _with_pages(marked, long, key, n_long).withColumn(page, numbers)
    return documents.join(repeated, [key, page]).select(*headers.columns, page, items)


def _with_pages(df: DataFrame, long: DataFrame, key: str, n_long: int) -> DataFrame:
    """The frame with the number of pages of long keys, its rows left where they are if possible."""
    if n_long <= BROADCAST_KEYS:
        return df.join(F.broadcast(long), key, "left")
    salt = F.pmod("_place", F.lit(SALTS)).alias("_salt")
    copies = long.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = copies.withColumn("_salt", F.col("_salt").cast("bigint"))
    return df.withColumn("_salt", salt).join(copies, [key, "_salt"], "left").drop("_salt")
