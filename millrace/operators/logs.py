"""Decoding of message-log envelopes and of the payloads they carry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import decode_json, event_time
from millrace.schemas import BUY, INVOICE, SELL, SENSOR, TRADE

# What makes two records the same: the time, and the payload byte for byte.
RECORD_KEY = ["timestamp", "fingerprint"]
MALFORMED = "malformed"


def decode_log(
    log: DataFrame, schema: T.StructType | str = INVOICE, keep: Sequence[str] = ()
) -> DataFrame:
    """Key as text and value as a struct, with topic and timestamp as they came.

    ``keep`` names further envelope columns to carry, such as ``offset``.
    """
    return log.select(
        F.col("key").cast("string").alias("key"),
        decode_json("value", schema).alias("value"),
        "topic",
        "timestamp",
        *keep,
    )


def checked_log(
    log: DataFrame, schema: T.StructType | str = INVOICE, keep: Sequence[str] = ()
) -> DataFrame:
    """The decoded log with the payload itself in ``malformed`` where it does not fit the schema.

    Malformed is text that is no JSON object, the empty text among it, and a field whose value is
    of another type than the schema's. A null payload is well formed and decodes to null; fields
    that the schema does not name, or that are left out, are well formed too. A malformed record
    keeps those fields that could be read.

    The payload is parsed once for both columns: it comes out of a generator, so no filter on
    either is pushed below the parser, and Spark never narrows a parse that reports bad text.
    """
    text = F.col("value").cast("string")
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    named = {field.name.lower() for field in fields}
    bad = next(n for n in ("_bad", *(f"_bad{i}" for i in range(len(named)))) if n not in named)
    with_bad = T.StructType([*fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json(text, with_bad, {"columnNameOfCorruptRecord": bad})
    record = F.inline(F.array(F.struct(parsed.alias("_record"), text.alias("_text"))))
    rows = log.select(F.col("key").cast("string").alias("key"), "topic", "timestamp", *keep, record)
    value = F.col("_record")
    unread = value.isNull() & F.col("_text").isNotNull()
    return rows.select(
        "key",
        F.when(value.isNotNull(), F.struct(*[value[n].alias(n) for n in fields.names])).alias("value"),
        "topic",
        "timestamp",
        *keep,
        F.when(unread, F.col("_text")).otherwise(value[bad]).alias(MALFORMED),
    )


def split_malformed(
    log: DataFrame, schema: T.StructType | str = INVOICE, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The well-formed records decoded, and the malformed ones with their payload as text.

    Two views of one ``checked_log``. Each of them is lazy and scans the log, so where both are
    wanted write ``checked_log`` once, e.g. as a table partitioned by whether ``malformed`` is null.
    """
    rows = checked_log(log, schema, keep)
    good = rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    bad = rows.where(F.col(MALFORMED).isNotNull())
    return good, bad.select("key", F.col(MALFORMED).alias("value"), "topic", "timestamp", *keep)


def trades(log: DataFrame, schema: T.StructType | str = TRADE) -> DataFrame:
    """Trades of a log with the amount put under ``Buy`` or ``Sell``, zero under the other.

    A trade of the right type with no amount has a null there. Text that is no time gives a null
    ``CreatedTime``.
    """
    return trade_columns(log.select(payload_fields(schema)))


def trade_columns(payloads: DataFrame) -> DataFrame:
    """Payload fields of trades with the time read and the amount put under its side."""
    return payloads.withColumns(
        {
            "CreatedTime": event_time("CreatedTime"),
            "Buy": F.when(F.col("Type") == BUY, F.col("Amount")).otherwise(0),
            "Sell": F.when(F.col("Type") == SELL, F.col("Amount")).otherwise(0),
        }
    )


def sensor_readings(log: DataFrame, schema: T.StructType | str = SENSOR) -> DataFrame:
    """Readings of a log whose key is the sensor."""
    sensor = F.col("key").cast("string").alias("SensorID")
    rows = log.select(sensor, payload_fields(schema))
    return rows.withColumn("CreatedTime", event_time("CreatedTime"))


def payload_fields(schema: T.StructType | str) -> Column:
    """The fields of the JSON payload as columns.

    Expanded as the one row of an array and not as ``struct.*``: the filter on the event time
    that a window brings along is then not pushed below the parsing, which would do it twice.
    """
    return F.inline(F.array(decode_json("value", schema)))


def fingerprint(payload: str | Column = "value") -> Column:
    """32 bytes that stand for a payload, byte for byte; null for a null payload."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.unhex(F.sha2(payload.cast("binary"), 256))


def distinct_records(log: DataFrame, schema: T.StructType | str = INVOICE) -> DataFrame:
    """Decoded log with one row per payload and time, the one with the highest offset.

    Payloads are the same if their bytes are, whatever the schema makes of them; null payloads are
    the same. Among equal offsets the higher partition wins, then the topic of the higher hash.
    Rows repeated whole are one. The row's ``fingerprint`` and time make up ``RECORD_KEY``.
    """
    place = record_place().alias("_place")
    marked = log.withColumns({"fingerprint": fingerprint(), "_place": place})
    return decode_log(newest_rows(marked, RECORD_KEY, "_place"), schema, keep=["fingerprint"])


def record_place() -> Column:
    """Offset, partition and a hash of the topic in one number, ordered in this order."""
    number, wide = "decimal(38,0)", F.lit(1 << 32).cast("decimal(10,0)")
    place = F.coalesce("offset", F.lit(-1)).cast(number)
    for part in (
        F.coalesce("partition", F.lit(-1)) + F.lit(1),
        F.crc32(F.coalesce("topic", F.lit("")).cast("binary")),
    ):
        place = (place * wide + part.cast("decimal(10,0)")).cast(number)
    return place


def newest_rows(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One whole row per key, of those with the highest ``version``, a number that is then dropped.

    The highest version of each key comes from a hash aggregate over the keys and versions alone,
    folded map-side, and the rows are then found by key and version in a hash join: whole rows move
    once and are never sorted, and copies of a key with different versions never meet in one task.
    Rows that are equal in everything are one; a null version is the lowest. Null keys are equal.
    ``df`` is read twice.
    """
    number = F.col(version).cast("decimal(38,0)")
    marks = {
        "_id": F.struct(*keys),  # never null itself, and nulls inside it equal each other
        "_version": F.coalesce(number, F.lit(-(1 << 62)).cast("decimal(38,0)")),
    }
    rows = df.withColumns(marks).drop(version)
    newest = rows.groupBy("_id").agg(F.max("_version").alias("_version"))
    dealt = rows.repartition("_id", "_version")
    found = dealt.join(newest.hint("shuffle_hash"), ["_id", "_version"]).distinct()
    return found.select(*[name for name in df.columns if name != version])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the one with the highest values of ``order``.

    An aggregate rather than a ranking window: copies of a key fold on the map side, so a key
    with very many copies never meets in one task. Null keys fold together too.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)
