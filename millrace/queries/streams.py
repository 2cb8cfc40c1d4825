"""Streaming queries over the test tables. Each ends by itself and returns the stored result."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import as_double
from millrace.plans import (
    accumulate_store,
    bronze_invoices,
    closed_sensor_windows,
    closed_trade_windows,
    idempotent_store,
    ingest_checked,
    ingest_idempotent,
    ingest_log,
    invoice_lines_stream,
    observed_trades,
    rewards_accumulated,
    rewards_complete,
    rewards_store,
    rewards_updated,
    sensor_maximum_stream,
    trade_summary_stream,
    updated_sensor_windows,
    updated_trade_windows,
    updated_windows,
    window_store,
    word_count_stream,
)
from millrace.queries.batch import (
    REPLAY_START_MS,
    TOTALS,
    bounds_as_ntz,
    checked_records,
    flat_record,
)
from millrace.queries.inputs import (
    EVENT_PAYLOAD,
    EXACT_TRADE,
    by_year,
    damaged_log,
    event_log,
    invoice_headers,
    key_value,
    load,
    nested_invoices,
    scratch_table,
    time_waves,
)
from millrace.schemas import INVOICE_COLUMNS, ITEM_COLUMNS, LOG_TABLE
from millrace.session import SHUFFLE_PARTITIONS_CONF, rocksdb_state, run_dir, state_partitions
from millrace.sources import envelope_files, from_timestamp, table
from millrace.streaming import Snapshots, listening, state_rows, stored_bytes, watermark

# Bounds of a micro-batch as long as few batches drain what there is to read.
TEXT_BYTES = 16 << 20
PARQUET_BYTES = 2 << 20
BATCHES = 4
STATE_BYTES = 4 << 20  # of input, for one partition of state

LINE_COLUMNS = [*(name.split(".")[-1] for name in INVOICE_COLUMNS), *ITEM_COLUMNS]


def batch_bytes(spark: SparkSession, path: str, least: int) -> int:
    """Bound of a micro-batch that drains ``path``: ``least``, or the share of one in ``BATCHES``.

    Each batch of complete mode writes the whole result, and each loads and commits all state
    partitions, so batches of a fixed size would cost the square of what there is to read.
    """
    return max(least, -(-stored_bytes(spark, path) // BATCHES))


def fitting_state(spark: SparkSession, path: str) -> AbstractContextManager[None]:
    """State in as many partitions as the rows under ``path`` fill, at most the session's.

    A batch loads and commits each partition, however little is in it.
    """
    filled = 1 + stored_bytes(spark, path) // STATE_BYTES
    most = int(spark.conf.get(SHUFFLE_PARTITIONS_CONF))
    return state_partitions(spark, min(most, max(filled, spark.sparkContext.defaultParallelism)))


def balanced(df: DataFrame, folder: str) -> DataFrame:
    """Rows of one folder together, in as many tasks as they fill; not a file per task and folder."""
    return df.hint("rebalance", F.col(folder))


def landed_invoices(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Nested invoices as compressed JSON files in folders by year."""
    path = f"{root}/landing"
    nested = nested_invoices(load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem"))
    rows = balanced(by_year(nested), "year")
    rows.write.partitionBy("year").option("compression", "gzip").json(path)
    return path


def landed_headers(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Invoices without line items as JSON files in folders by year."""
    path = f"{root}/landing"
    headers = by_year(invoice_headers(load(spark, sf_dir, "orders")))
    balanced(headers, "year").write.partitionBy("year").json(path)
    return path


def landed_log(spark: SparkSession, sf_dir: str, root: str) -> str:
    """The event log as envelope files in folders by day."""
    path = f"{root}/log"
    log = event_log(load(spark, sf_dir, "events"))
    days = log.withColumn("day", F.to_date("timestamp"))
    balanced(days, "day").write.partitionBy("day").parquet(path)
    return path


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_word_count")
    text, result = f"{root}/text", Snapshots(f"{root}/counts")
    texts = load(spark, sf_dir, "documents").select("text", "lang")
    balanced(texts, "lang").write.partitionBy("lang").option("lineSep", ".").text(text)
    with fitting_state(spark, text):
        word_count_stream(
            spark, text, result.save, f"{root}/checkpoint", "batch",
            max_bytes=batch_bytes(spark, text, TEXT_BYTES),
        ).awaitTermination()
    return result.read(spark)


def stream_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_invoice_lines")
    landing, items = landed_invoices(spark, sf_dir, root), f"{root}/items"
    share = batch_bytes(spark, landing, TEXT_BYTES)
    with scratch_table(spark) as name:
        invoice_lines_stream(
            spark, landing, f"{root}/checkpoint", name, "batch", path=items, max_bytes=share
        ).awaitTermination()
    return spark.read.parquet(items).select(*LINE_COLUMNS)


def running_invoice_lines(spark: SparkSession, sf_dir: str, trigger: str | None) -> DataFrame:
    """Line items from a query that would run on, stopped when it has caught up."""
    root = run_dir(spark, "running_invoice_lines")
    landing, items = landed_invoices(spark, sf_dir, root), f"{root}/items"
    share = batch_bytes(spark, landing, TEXT_BYTES)
    with scratch_table(spark) as name:
        query = invoice_lines_stream(
            spark, landing, f"{root}/checkpoint", name, trigger, path=items, max_bytes=share
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return spark.read.parquet(items).select(*LINE_COLUMNS)


def stream_default_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_invoice_lines(spark, sf_dir, None)


def stream_interval_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_invoice_lines(spark, sf_dir, "1 second")


def stream_log_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_log_to_bronze")
    path, bronze = landed_log(spark, sf_dir, root), f"{root}/bronze"
    share = batch_bytes(spark, path, PARQUET_BYTES)
    log = envelope_files(spark, path, stream=True, max_bytes=share)
    with scratch_table(spark) as name:
        ingest_log(
            log, f"{root}/checkpoint", name, EVENT_PAYLOAD, "batch", bronze
        ).awaitTermination()
    return flat_record(spark.read.parquet(bronze))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_restart")
    bronze = f"{root}/bronze"
    with scratch_table(spark) as name:
        for wave in time_waves(load(spark, sf_dir, "events"), 2):
            event_log(wave).write.mode("append").parquet(f"{root}/log")
            log = envelope_files(spark, f"{root}/log", stream=True)
            ingest_log(
                log, f"{root}/checkpoint", name, EVENT_PAYLOAD, "batch", bronze
            ).awaitTermination()
    return flat_record(spark.read.parquet(bronze))


def stream_idempotent_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_idempotent_ingest")
    events = load(spark, sf_dir, "events")
    again = from_timestamp(event_log(events, "events-replay", 1), REPLAY_START_MS)
    store = idempotent_store(f"{root}/bronze", roll_up_every=2)
    for delivery in (*map(event_log, time_waves(events, 2)), again):
        delivery.write.mode("append").parquet(f"{root}/log")
        log = envelope_files(spark, f"{root}/log", stream=True)
        ingest_idempotent(
            log, store.apply, f"{root}/checkpoint", EVENT_PAYLOAD, "batch"
        ).awaitTermination()
    return flat_record(store.read(spark))


def stream_rewards_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_rewards_complete")
    landing, result = landed_headers(spark, sf_dir, root), Snapshots(f"{root}/rewards")
    with scratch_table(spark) as bronze:
        bronze_invoices(
            spark, landing, f"{root}/bronze_checkpoint", bronze, "batch",
            path=f"{root}/bronze", max_bytes=batch_bytes(spark, landing, TEXT_BYTES),
        ).awaitTermination()
        with fitting_state(spark, f"{root}/bronze"):
            rewards_complete(
                spark, bronze, result.save, f"{root}/checkpoint", "batch",
                exact=True, max_bytes=batch_bytes(spark, f"{root}/bronze", PARQUET_BYTES),
            ).awaitTermination()
    return as_double(result.read(spark))


def stream_rewards_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_rewards_update")
    landing, store = landed_headers(spark, sf_dir, root), rewards_store(f"{root}/rewards")
    with scratch_table(spark) as bronze, rocksdb_state(spark):
        bronze_invoices(
            spark, landing, f"{root}/bronze_checkpoint", bronze, "batch",
            path=f"{root}/bronze", max_bytes=batch_bytes(spark, landing, TEXT_BYTES),
        ).awaitTermination()
        with fitting_state(spark, f"{root}/bronze"):
            rewards_updated(
                spark, bronze, store.apply, f"{root}/checkpoint", "batch",
                exact=True, max_bytes=batch_bytes(spark, f"{root}/bronze", PARQUET_BYTES),
            ).awaitTermination()
    return as_double(store.read(spark))


def stream_rewards_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_rewards_accumulate")
    landing = landed_headers(spark, sf_dir, root)
    store = accumulate_store(f"{root}/rewards", roll_up_every=2)
    with scratch_table(spark) as bronze:
        bronze_invoices(
            spark, landing, f"{root}/bronze_checkpoint", bronze, "batch",
            path=f"{root}/bronze", max_bytes=batch_bytes(spark, landing, TEXT_BYTES),
        ).awaitTermination()
        rewards_accumulated(
            spark, bronze, store.apply, f"{root}/checkpoint", "batch",
            exact=True, max_bytes=batch_bytes(spark, f"{root}/bronze", PARQUET_BYTES),
        ).awaitTermination()
    return as_double(store.read(spark))


def stream_trade_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_trade_summary")
    first, second, third = time_waves(load(spark, sf_dir, "events"))
    result = Snapshots(f"{root}/summary")
    # The oldest trades come last: complete mode counts them however late they are.
    for wave in (second, third, first):
        event_log(wave).write.mode("append").parquet(f"{root}/log")
        log = envelope_files(spark, f"{root}/log", stream=True)
        trade_summary_stream(
            log, result.save, f"{root}/checkpoint", "batch", schema=EXACT_TRADE
        ).awaitTermination()
    return as_double(bounds_as_ntz(result.read(spark)), TOTALS)


def stream_sensor_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_sensor_sliding")
    path, result = landed_log(spark, sf_dir, root), Snapshots(f"{root}/summary")
    share = batch_bytes(spark, path, PARQUET_BYTES)
    log = envelope_files(spark, path, stream=True, max_bytes=share)
    with fitting_state(spark, path):
        sensor_maximum_stream(
            log, result.save, f"{root}/checkpoint", "batch", slide="5 minutes"
        ).awaitTermination()
    return bounds_as_ntz(result.read(spark))


def stream_sensor_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_sensor_append")
    # Waves in time order, one run each, so that no reading comes later than the watermark.
    with scratch_table(spark) as name:
        for wave in time_waves(load(spark, sf_dir, "events")):
            event_log(wave).write.mode("append").parquet(f"{root}/log")
            log = envelope_files(spark, f"{root}/log", stream=True)
            closed_sensor_windows(
                log, f"{root}/checkpoint", name, "batch", path=f"{root}/summary"
            ).awaitTermination()
    return bounds_as_ntz(spark.read.parquet(f"{root}/summary"))


def stream_inserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_inserted_rows")
    result = Snapshots(f"{root}/summary")
    waves = [key_value(event_log(wave)) for wave in time_waves(load(spark, sf_dir, "events"))]
    with scratch_table(spark) as name:
        insert = f"INSERT INTO {name} SELECT key, value FROM {{rows}}"
        spark.sql(f"CREATE TABLE {name} ({LOG_TABLE}) USING parquet LOCATION '{root}/table'")
        spark.sql(insert, rows=waves[0])
        query = trade_summary_stream(
            table(spark, name, stream=True), result.save, f"{root}/checkpoint", schema=EXACT_TRADE
        )
        try:
            for rows in waves[1:]:
                query.processAllAvailable()
                spark.sql(insert, rows=rows)
            query.processAllAvailable()
        finally:
            query.stop()
    return as_double(bounds_as_ntz(result.read(spark)), TOTALS)


def stream_log_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_log_checked")
    damaged_log(load(spark, sf_dir, "events")).write.parquet(f"{root}/log")
    share = batch_bytes(spark, f"{root}/log", PARQUET_BYTES)
    log = envelope_files(spark, f"{root}/log", stream=True, max_bytes=share)
    with scratch_table(spark) as name:
        ingest_checked(
            log, f"{root}/checkpoint", name, EVENT_PAYLOAD, "batch", f"{root}/sides"
        ).awaitTermination()
    return checked_records(spark.read.parquet(f"{root}/sides"))


def stream_trade_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_trade_update")
    store = window_store(f"{root}/windows", roll_up_every=2)
    # Waves in time order, so that no trade comes later than the watermark.
    for wave in time_waves(load(spark, sf_dir, "events")):
        event_log(wave).write.mode("append").parquet(f"{root}/log")
        log = envelope_files(spark, f"{root}/log", stream=True)
        updated_trade_windows(
            log, store.apply, f"{root}/checkpoint", "batch", schema=EXACT_TRADE
        ).awaitTermination()
    return as_double(bounds_as_ntz(store.read(spark)), TOTALS)


def stream_sensor_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_sensor_update")
    store = window_store(f"{root}/windows", ["SensorID"])
    for wave in time_waves(load(spark, sf_dir, "events")):
        event_log(wave).write.mode("append").parquet(f"{root}/log")
        log = envelope_files(spark, f"{root}/log", stream=True)
        updated_sensor_windows(
            log, store.apply, f"{root}/checkpoint", "batch", slide="5 minutes"
        ).awaitTermination()
    return bounds_as_ntz(store.read(spark))


def stream_trade_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_trade_append")
    with scratch_table(spark) as name:
        for wave in time_waves(load(spark, sf_dir, "events")):
            event_log(wave).write.mode("append").parquet(f"{root}/log")
            log = envelope_files(spark, f"{root}/log", stream=True)
            closed_trade_windows(
                log, f"{root}/checkpoint", name, "batch", path=f"{root}/windows",
                schema=EXACT_TRADE,
            ).awaitTermination()
    return as_double(bounds_as_ntz(spark.read.parquet(f"{root}/windows")), TOTALS)


def stream_state_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_state_readback")
    checkpoint = f"{root}/checkpoint"
    with scratch_table(spark) as name, rocksdb_state(spark):
        for wave in time_waves(load(spark, sf_dir, "events")):  # a restart for each
            event_log(wave).write.mode("append").parquet(f"{root}/log")
            log = envelope_files(spark, f"{root}/log", stream=True)
            closed_sensor_windows(
                log, checkpoint, name, "batch", path=f"{root}/summary"
            ).awaitTermination()
        open_windows = state_rows(spark, checkpoint)
    reached = F.broadcast(watermark(spark, checkpoint))
    rows = open_windows.select(
        "SensorID",
        F.col("window.start").cast("timestamp_ntz").alias("start"),
        F.col("window.end").cast("timestamp_ntz").alias("end"),
        F.col("max").alias("MaxReading"),
        F.lit(1).alias("_one"),
    )
    reached = reached.select(
        F.col("watermark").cast("timestamp_ntz").alias("watermark"), F.lit(1).alias("_one")
    )
    return rows.join(reached, "_one").drop("_one")


def stream_observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream_observed_counts")
    store = window_store(f"{root}/windows")
    first, second, third = time_waves(load(spark, sf_dir, "events"))
    with listening(spark) as metrics:
        # The oldest trades come last and mostly later than the watermark, so they are dropped.
        for wave in (second, third, first):
            damaged_log(wave).write.mode("append").parquet(f"{root}/log")
            log = envelope_files(spark, f"{root}/log", stream=True)
            query = updated_windows(
                observed_trades(log, EXACT_TRADE), [F.count("*").alias("n")], store.apply,
                f"{root}/checkpoint", "batch", name="observed-trades",
            )
            query.awaitTermination()
            metrics.wait(query)
    counts = {name: metrics.total("trades", name) for name in ("rows_in", "malformed", "untimed")}
    counted = F.coalesce(F.sum("n"), F.lit(0))
    timed = F.lit(counts["rows_in"] - counts["malformed"] - counts["untimed"])
    return store.read(spark).agg(
        *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()],
        counted.cast("bigint").alias("counted"),
        (timed - counted).cast("bigint").alias("late"),
    )


QUERIES = {
    "stream_word_count": stream_word_count,
    "stream_invoice_lines": stream_invoice_lines,
    "stream_default_trigger": stream_default_trigger,
    "stream_interval_trigger": stream_interval_trigger,
    "stream_log_to_bronze": stream_log_to_bronze,
    "stream_restart": stream_restart,
    "stream_idempotent_ingest": stream_idempotent_ingest,
    "stream_rewards_complete": stream_rewards_complete,
    "stream_rewards_update": stream_rewards_update,
    "stream_rewards_accumulate": stream_rewards_accumulate,
    "stream_trade_summary": stream_trade_summary,
    "stream_sensor_sliding": stream_sensor_sliding,
    "stream_sensor_append": stream_sensor_append,
    "stream_inserted_rows": stream_inserted_rows,
    "stream_log_checked": stream_log_checked,
    "stream_trade_update": stream_trade_update,
    "stream_sensor_update": stream_sensor_update,
    "stream_trade_append": stream_trade_append,
    "stream_state_readback": stream_state_readback,
    "stream_observed_counts": stream_observed_counts,
}
