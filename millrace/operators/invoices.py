"""Flattening of nested invoices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schemas import INVOICE_COLUMNS

def line_items(invoices: DataFrame) -> DataFrame:
    """One flat row per line item. An invoice with no or null line items gives none."""
    rows = invoices.select(*INVOICE_COLUMNS, F.explode("InvoiceLineItems").alias("item"))
    return rows.select("*", "item.*").drop("item")
