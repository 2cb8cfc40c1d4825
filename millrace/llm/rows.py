"""A key of its own for every row, where ids may be null or repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import stored

ROW = "__row_id"


def ids_are_keys(docs: DataFrame, doc_id: str) -> bool:
    """Whether no id is there twice, a null one included. Ids are counted map-side."""
    counts = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where("__n > 1").isEmpty()


def with_row_ids(docs: DataFrame, doc_id: str, text: str, unique: bool) -> DataFrame:
    """The rows with ``ROW``, a long that no two share and that is in the order of the ids.

    Unique ids are their own keys. Else the rows are sorted by id, null first, and by a hash of the
    text, and numbered; they are written once, so the numbers stay as they are. Rows of one id, any
    number of them, are sorted in many tasks.
    """
    if unique:
        return docs.withColumn(ROW, F.col(doc_id).cast("bigint"))
    order = [F.asc_nulls_first(doc_id), F.asc("__hash")]
    hashed = docs.withColumn("__hash", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    dealt = hashed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__hash")
    return stored(dealt.withColumn(ROW, F.monotonically_increasing_id()))


def with_text_ids(docs: DataFrame, doc_id: str, text: str, unique: bool) -> DataFrame:
    """The same, but rows of one id with one text share their ``ROW``."""
    if unique:
        return docs.withColumn(ROW, F.col(doc_id).cast("bigint"))
    hashed = docs.withColumn("__hash", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    order = [F.asc_nulls_first("__id"), F.asc("__text")]
    kinds = hashed.select(F.col(doc_id).alias("__id"), F.col("__hash").alias("__text")).distinct()
    dealt = kinds.repartitionByRange(*order).sortWithinPartitions(*order)
    keys = stored(dealt.withColumn(ROW, F.monotonically_increasing_id()))
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__text"))
    return hashed.join(keys, same).drop("__hash", "__id", "__text")
