"""The operators and plans run over the test tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.queries import batch, streams
from millrace.queries.oracle import ORACLE
from millrace.session import utc

Query = Callable[[SparkSession, str], DataFrame]


def in_utc(query: Query) -> Query:
    """The query with wall-clock columns read as UTC, and the session's own zone after it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with utc(spark):
            return query(spark, sf_dir)

    return run


QUERIES = {name: in_utc(query) for name, query in (batch.QUERIES | streams.QUERIES).items()}

__all__ = ["ORACLE", "QUERIES"]
