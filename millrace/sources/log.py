"""Message-log sources: a Kafka topic, or files that hold the same envelope columns.

A new reader starts at the beginning of the log unless it is given a time, and is told what to do
about a time that no record has reached yet. A stream that goes on from its checkpoint takes no
start at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import LOG_ENVELOPE
from millrace.sources.files import reader

PAST_END = ("error", "latest")
PLACE = ["topic", "partition"]


def kafka_options(
    servers: str,
    topic: str,
    start_ms: int | None = None,
    max_records: int | None = None,
    user: str | None = None,
    secret: str | None = None,
    past_end: str = "error",
) -> dict[str, str]:
    """Options of Spark's Kafka source; credentials come from the caller and are not kept.

    A new query starts at the earliest record, or at ``start_ms``, an inclusive epoch-millisecond
    position. Where a partition has no record at or after it, ``past_end`` says whether to fail
    (``"error"``) or to start at that partition's end (``"latest"``). ``max_records`` bounds one
    micro-batch.
    """
    check_past_end(past_end)
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start_ms is None:
        options["startingOffsets"] = "earliest"
    else:
        options["startingTimestamp"] = str(start_ms)
        options["startingOffsetsByTimestampStrategy"] = past_end
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    if user is not None or secret is not None:
        if user is None or secret is None:
            raise ValueError("a login takes a user and a secret")
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                f"{login} required username={quoted(user)} password={quoted(secret)};"
            ),
        }
    return options


def check_past_end(past_end: str) -> None:
    if past_end not in PAST_END:
        raise ValueError(f"past_end is one of {PAST_END}, not {past_end!r}")


def quoted(value: str) -> str:
    """A value of a login line, whatever quotes and backslashes are in it."""
    if "\n" in value or "\r" in value:
        raise ValueError("a login value has no line ends")
    escaped = value.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'


def kafka_log(spark: SparkSession, options: dict[str, str], stream: bool = False) -> DataFrame:
    """A topic, whole or as a stream. Needs the Kafka connector on the class path."""
    return reader(spark, stream).format("kafka").options(**options).load()


def envelope_files(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    start_ms: int | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    past_end: str = "error",
) -> DataFrame:
    """Parquet files of envelope rows read as if they were the topic.

    ``start_ms`` keeps the records at or after that time. If the files hold none yet, ``past_end``
    decides: ``"error"`` raises, ``"latest"`` leaves out what is there now, so that a stream hands
    over what arrives from here on, whatever its time.

    Files written with ``maxRecordsPerFile`` = n and read with ``max_files`` = m bound a
    micro-batch to n * m records.
    """
    check_past_end(past_end)
    log = reader(spark, stream, max_files, max_bytes).schema(LOG_ENVELOPE).parquet(path)
    if start_ms is None:
        return log
    there = spark.read.schema(LOG_ENVELOPE).parquet(path)
    if not from_timestamp(there, start_ms).isEmpty():
        return from_timestamp(log, start_ms)
    if past_end == "error":
        raise ValueError(f"no record of {path} is at or after {start_ms}")
    return after_offsets(log, last_offsets(there))


def from_timestamp(log: DataFrame, start_ms: int) -> DataFrame:
    """Records at or after an epoch-millisecond position; the filter reaches the Parquet scan."""
    return log.where(F.col("timestamp") >= F.timestamp_millis(F.lit(start_ms)))


def last_offsets(log: DataFrame) -> list[tuple[str, int, int]]:
    """The last offset of each topic and partition, of which a log has a fixed few."""
    ends = log.groupBy(*PLACE).agg(F.max("offset").alias("offset"))
    return [(r["topic"], r["partition"], r["offset"]) for r in ends.collect()]


def after_offsets(log: DataFrame, ends: list[tuple[str, int, int]]) -> DataFrame:
    """Records behind the given offsets; a topic or partition not among them is kept whole."""
    if not ends:
        return log
    known = log.sparkSession.createDataFrame(ends, "topic string, partition int, _end bigint")
    joined = log.join(F.broadcast(known), PLACE, "left")
    ahead = F.col("_end").isNull() | (F.col("offset") > F.col("_end"))
    return joined.where(ahead).select(*log.columns)
