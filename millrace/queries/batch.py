"""Batch queries over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import (
    as_double,
    checked_log,
    decode_log,
    distinct_records,
    line_items,
    peek,
    rewards,
    row_count,
    sensor_maximum,
    sensor_readings,
    tokens,
    total_with_prefix,
    trade_summary,
    trades,
    upsert,
    window_rows,
    word_count,
)
from millrace.plans import net_position_report, word_count_table
from millrace.queries.inputs import (
    EVENT_PAYLOAD,
    EXACT_TRADE,
    TABLES,
    damaged_log,
    event_log,
    invoice_headers,
    key_value,
    load,
    nested_invoices,
    scratch_table,
)
from millrace.queries.inputs import invoice_documents as documents
from millrace.session import run_dir
from millrace.sources import (
    csv_rows,
    envelope_files,
    from_timestamp,
    json_inferred,
    sentences,
    table,
    with_input_file,
)

TOTALS = ["TotalBuy", "TotalSell"]
# 2024-01-15 00:00:00 UTC, the start position of the queries that read part of a log.
REPLAY_START_MS = 1_705_276_800_000


def bounds_as_ntz(df: DataFrame) -> DataFrame:
    """Window bounds as wall-clock times, the type of the test tables."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("start", "end")})


def flat_record(decoded: DataFrame) -> DataFrame:
    """Decoded log rows with the payload's fields side by side."""
    rows = decoded.select("key", "value.*", "topic", "timestamp")
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """Document texts as text files, each text ended by a separator of its own."""
    path = run_dir(spark, "text")
    texts = load(spark, sf_dir, "documents").select("text")
    texts.write.option("lineSep", ".").text(path)
    return path


def stored_counts(rows: DataFrame, label: str) -> DataFrame:
    """How often each row occurs, counted map-side first and kept in the shared folder."""
    path = run_dir(rows.sparkSession, label)
    rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Cutting at the dots and then at the spaces is cutting at either.
    return tokens(load(spark, sf_dir, "documents"), "text", "[. ]")


def summarised_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(load(spark, sf_dir, "events"))
    return trade_summary(trades(log, EXACT_TRADE))


def order_rewards(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    orders = load(spark, sf_dir, "orders").where(where)
    return rewards(invoice_headers(orders), exact=True)


def text_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentences(spark, text_files(spark, sf_dir)).select(F.col("value").alias("sentence"))
    return stored_counts(pieces, "text_sentences")


def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens(load(spark, sf_dir, "documents"), "text", "[. ]", keep=["doc_id"])
    return stored_counts(words, "word_tokens")


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(document_words(spark, sf_dir))


def word_count_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, path = text_files(spark, sf_dir), run_dir(spark, "word_count")
    with scratch_table(spark) as name:
        for _ in range(2):
            word_count_table(spark, text, name, path)
        return table(spark, name)


def words_with_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_with_prefix(word_counts(spark, sf_dir), "s")


def json_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "json")
    props = F.from_json("props", "k bigint").alias("props")
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "value", props)
    events.write.json(path)
    return json_inferred(spark, path).select("event_id", "user_id", "value", "props.k")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "csv")
    customers = load(spark, sf_dir, "customer")
    customers.write.option("header", True).csv(path)
    return csv_rows(spark, path, customers.schema)


def source_file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    def lines_per_file(name: str) -> DataFrame:
        rows = with_input_file(load(spark, sf_dir, name))
        file = F.element_at(F.split("InputFile", "/"), -1).alias("input_file")
        return rows.groupBy(file).agg(F.count("*").alias("n_rows"))

    return lines_per_file("orders").unionByName(lines_per_file("lineitem"))


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        row_count(load(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "n_rows")
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def peek_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peek(load(spark, sf_dir, "orders"), 10, ["o_orderkey"])


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    return line_items(nested_invoices(orders, lines))


def invoice_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    quantity = F.aggregate(
        "InvoiceLineItems", F.lit(0).cast("bigint"), lambda total, item: total + item["ItemQty"]
    )
    return documents(orders, lines).select(
        "InvoiceNumber",
        "PageNumber",
        F.size("InvoiceLineItems").cast("bigint").alias("n_items"),
        quantity.alias("quantity"),
    )


def log_batch_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "log")
    event_log(load(spark, sf_dir, "events")).write.parquet(path)
    return envelope_files(spark, path).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_record(decode_log(event_log(load(spark, sf_dir, "events")), EVENT_PAYLOAD))


def checked_records(checked: DataFrame) -> DataFrame:
    """Records with a flag, the payload of the malformed and the fields of the others."""
    bad = F.col("malformed").isNotNull()
    fields = [
        F.when(~bad, F.col("value")[name]).alias(name)
        for name in checked.schema["value"].dataType.names
    ]
    return checked.select("key", "offset", bad.alias("is_malformed"), "malformed", *fields)


def log_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = damaged_log(load(spark, sf_dir, "events"))
    return checked_records(checked_log(log, EVENT_PAYLOAD, keep=["offset"]))


def log_from_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "log")
    event_log(load(spark, sf_dir, "events")).write.parquet(path)
    log = envelope_files(spark, path, start_ms=REPLAY_START_MS)
    return flat_record(decode_log(log, EVENT_PAYLOAD))


def sensor_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = sensor_readings(key_value(event_log(load(spark, sf_dir, "events"))))
    return readings.withColumn("CreatedTime", F.col("CreatedTime").cast("timestamp_ntz"))


def trade_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trades(key_value(event_log(load(spark, sf_dir, "events"))))
    return rows.withColumn("CreatedTime", F.col("CreatedTime").cast("timestamp_ntz"))


def customer_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(order_rewards(spark, sf_dir))


def rewards_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = rewards(invoice_headers(load(spark, sf_dir, "orders")))
    # The last bits of a sum of doubles depend on its order; amounts have two decimals.
    return totals.select(
        "CustomerCardNo",
        F.round("TotalAmount", 2).alias("TotalAmount"),
        F.round("TotalPoints", 4).alias("TotalPoints"),
    )


def trade_summary_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(load(spark, sf_dir, "events"))
    summary = trade_summary(trades(log, EXACT_TRADE), slide="5 minutes")
    return as_double(bounds_as_ntz(summary), TOTALS)


def trade_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(bounds_as_ntz(summarised_trades(spark, sf_dir)), TOTALS)


def sensor_max_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(load(spark, sf_dir, "events"))
    return bounds_as_ntz(sensor_maximum(sensor_readings(log)))


def sensor_max_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(load(spark, sf_dir, "events"))
    return bounds_as_ntz(sensor_maximum(sensor_readings(log), slide="5 minutes"))


def window_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "trade_summary")
    summarised_trades(spark, sf_dir).write.parquet(path)
    found = window_rows(
        spark.read.parquet(path), "2024-01-15 00:45:00", "2024-01-15 01:00:00"
    )
    return as_double(found.select(*TOTALS), TOTALS)


def running_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = net_position_report(summarised_trades(spark, sf_dir))
    report = report.withColumn("end", F.col("end").cast("timestamp_ntz"))
    return as_double(report, ["Buy", "Sell", "Net"])


def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = order_rewards(spark, sf_dir, "o_orderdate < timestamp_ntz '1998-01-01'")
    new = order_rewards(spark, sf_dir, "o_orderdate >= timestamp_ntz '1998-01-01'")
    return as_double(upsert(old, new, ["CustomerCardNo"]))


def upsert_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = order_rewards(spark, sf_dir, "o_orderdate < timestamp_ntz '1998-01-01'")
    new = order_rewards(spark, sf_dir, "o_orderdate >= timestamp_ntz '1998-01-01'")
    return as_double(upsert(old, new, ["CustomerCardNo"], "accumulate"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.lit(None).cast("double").alias("last_price")
    )
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("last_price"), "o_orderkey"
    )
    return upsert(customers, orders, ["custkey"], order=["o_orderkey"])


def idempotent_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    first = event_log(events)
    again = from_timestamp(event_log(events, "events-replay", 1), REPLAY_START_MS)
    return flat_record(distinct_records(first.unionByName(again), EVENT_PAYLOAD))


QUERIES = {
    "text_sentences": text_sentences,
    "word_tokens": word_tokens,
    "word_count": word_counts,
    "word_count_overwrite": word_count_overwrite,
    "words_with_prefix": words_with_prefix,
    "json_infer": json_infer,
    "csv_roundtrip": csv_roundtrip,
    "source_file_lineage": source_file_lineage,
    "row_count": row_counts,
    "peek_rows": peek_rows,
    "invoice_lines": invoice_lines,
    "invoice_documents": invoice_documents,
    "log_batch_read": log_batch_read,
    "log_parse": log_parse,
    "log_malformed": log_malformed,
    "log_from_timestamp": log_from_timestamp,
    "sensor_parse": sensor_parse,
    "trade_parse": trade_parse,
    "rewards": customer_rewards,
    "rewards_double": rewards_double,
    "trade_summary": trade_summaries,
    "trade_summary_sliding": trade_summary_sliding,
    "sensor_max_tumbling": sensor_max_tumbling,
    "sensor_max_sliding": sensor_max_sliding,
    "window_lookup": window_lookup,
    "running_net": running_net,
    "upsert_replace": upsert_replace,
    "upsert_accumulate": upsert_accumulate,
    "upsert_latest": upsert_latest,
    "idempotent_ingest": idempotent_ingest,
}
