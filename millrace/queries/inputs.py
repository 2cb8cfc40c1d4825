"""Text files, invoices and message logs derived from the test tables by Spark."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import EXACT_MONEY
from millrace.operators import nested
from millrace.schemas import BUY, EVENT_TIME_FORMAT, SELL

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Payload of the event log: a trade and a sensor reading in one.
EVENT_PAYLOAD = (
    "CreatedTime string, Type string, Amount double, BrokerCode string, Reading double"
)
EXACT_TRADE = f"CreatedTime string, Type string, Amount {EXACT_MONEY}, BrokerCode string"

WAVES = 3
# Of this many events, one has a payload cut short, one an amount in words, one no payload.
DAMAGE_EVERY = 50


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def invoice_headers(orders: DataFrame) -> DataFrame:
    """Orders as invoices without line items."""
    return orders.select(*header_columns())


def header_columns() -> list[Column]:
    """An invoice's own fields, from those of an order."""
    card = F.col("o_custkey").cast("string")
    return [
        F.col("o_orderkey").cast("string").alias("InvoiceNumber"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("CreatedTime"),
        F.concat(F.lit("STR"), F.col("o_orderkey") % 97).alias("StoreID"),
        F.concat(F.lit("POS"), F.col("o_orderkey") % 11).alias("PosID"),
        F.col("o_orderstatus").alias("CustomerType"),
        card.alias("CustomerCardNo"),
        F.col("o_totalprice").alias("TotalAmount"),
        F.col("o_orderpriority").alias("PaymentMethod"),
        F.lit("HOME-DELIVERY").alias("DeliveryType"),
        F.struct(
            F.concat(F.lit("City "), F.col("o_custkey") % 31).alias("City"),
            card.alias("PinCode"),
            F.col("o_orderstatus").alias("State"),
        ).alias("DeliveryAddress"),
    ]


def invoice_documents(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with their lines nested, in several numbered documents if there are very many."""
    item = F.struct(
        F.col("l_partkey").cast("string").alias("ItemCode"),
        F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("ItemDescription"),
        F.col("l_extendedprice").alias("ItemPrice"),
        F.col("l_quantity").cast("bigint").alias("ItemQty"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("TotalValue"),
    )
    headers = orders.withColumnRenamed("o_orderkey", "l_orderkey")
    documents = nested(headers, lines, "l_orderkey", item, "InvoiceLineItems", "PageNumber")
    documents = documents.withColumnRenamed("l_orderkey", "o_orderkey")
    return documents.select(*header_columns(), "PageNumber", "InvoiceLineItems")


def nested_invoices(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with their lines nested, and once more as bare headers with no lines."""
    full = invoice_documents(orders, lines).drop("PageNumber")
    no_lines = F.array().cast(full.schema["InvoiceLineItems"].dataType)
    bare = orders.select(*header_columns(), no_lines.alias("InvoiceLineItems"))
    return full.unionByName(bare)


def by_year(invoices: DataFrame) -> DataFrame:
    """Invoices with the landing folder's partition column."""
    return invoices.withColumn("year", F.year(F.timestamp_seconds("CreatedTime")))


def event_log(events: DataFrame, topic: str = "events", replay: int = 0) -> DataFrame:
    """Events as records of a message log; ``replay`` tells a second delivery from the first."""
    kind = F.col("event_type")
    payload = F.struct(
        F.date_format("ts", EVENT_TIME_FORMAT).alias("CreatedTime"),
        F.when(kind == "purchase", BUY).when(kind == "click", SELL).otherwise(kind).alias("Type"),
        F.col("value").alias("Amount"),
        kind.alias("BrokerCode"),
        F.col("value").alias("Reading"),
    )
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(replay).alias("partition"),
        (F.col("event_id") + F.lit(replay << 40)).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def damaged_log(events: DataFrame) -> DataFrame:
    """The event log with some payloads cut short, of the wrong type, or missing."""
    log = event_log(events)
    nth = F.pmod("offset", F.lit(DAMAGE_EVERY))
    text = F.col("value").cast("string")
    spoilt = (
        F.when(nth == 0, F.substring(text, 1, 20))
        .when(nth == 1, F.regexp_replace(text, '"Amount":[^,]*', '"Amount":"much"'))
        .when(nth == 2, F.lit(None))
        .otherwise(text)
    )
    return log.withColumn("value", spoilt.cast("binary"))


def key_value(log: DataFrame) -> DataFrame:
    """Key and value of a log as text, the form of a stored log table."""
    return log.select(F.col("key").cast("string"), F.col("value").cast("string"))


def time_waves(events: DataFrame, waves: int = WAVES) -> list[DataFrame]:
    """Events cut by time into slices of equal length; each is a filter on the scan.

    Events without a time are in the first.
    """
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        return [events, *[events.where(F.lit(False))] * (waves - 1)]
    cuts = [low + (high - low) / waves * i for i in range(1, waves)]
    bounds = [None, *[F.lit(str(c)).cast("timestamp_ntz") for c in cuts], None]
    slices = []
    for start, end in zip(bounds, bounds[1:]):
        part = events if start is None else events.where(F.col("ts") >= start)
        if end is not None:
            early = F.col("ts") < end
            part = part.where(early | F.col("ts").isNull() if start is None else early)
        slices.append(part)
    return slices


@contextmanager
def scratch_table(spark: SparkSession) -> Iterator[str]:
    """Name of a catalog table that goes away with the block; files at its path stay."""
    name = f"millrace_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
