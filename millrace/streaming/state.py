"""What a stopped streaming query remembers, read back from its checkpoint as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WATERMARK = "struct<batchWatermarkMs:bigint>"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: ids, names, state partitions and the batches kept."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(
    spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None
) -> DataFrame:
    """The state of an operator after a batch (the last one by default), a row per group.

    The grouping columns come first, under their own names, then the aggregates' buffers, as Spark
    calls them (``max``, ``sum``, ``count``), then the state partition as ``partition_id``.
    """
    source = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        source = source.option("batchId", batch)
    return source.load(checkpoint).select("key.*", "value.*", "partition_id")


def watermark(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The event-time watermark of a query's last planned batch, one row ``watermark``.

    Rows of windows that end by then are dropped from here on. The epoch, if none was reached.
    """
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "[0-9]*")
    offsets = files.load(f"{checkpoint}/offsets").select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).cast("bigint").alias("batch"),
        F.split("value", "\n")[1].alias("line"),  # the version, then what holds for the batch
    )
    millis = F.from_json(F.max_by("line", "batch"), WATERMARK)["batchWatermarkMs"]
    return offsets.agg(F.timestamp_millis(millis).alias("watermark"))
