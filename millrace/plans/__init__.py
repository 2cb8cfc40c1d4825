from millrace.plans.events import (
    closed_sensor_windows,
    closed_trade_windows,
    net_position_report,
    observed_trades,
    sensor_maximum_stream,
    trade_summary_stream,
    updated_sensor_windows,
    updated_trade_windows,
    updated_windows,
    window_store,
)
from millrace.plans.ingest import (
    idempotent_store,
    ingest_checked,
    ingest_idempotent,
    ingest_log,
)
from millrace.plans.invoices import invoice_lines_stream
from millrace.plans.rewards import (
    accumulate_store,
    bronze_invoices,
    rewards_accumulated,
    rewards_complete,
    rewards_store,
    rewards_updated,
)
from millrace.plans.words import word_count_stream, word_count_table

__all__ = [
    "accumulate_store",
    "bronze_invoices",
    "closed_sensor_windows",
    "closed_trade_windows",
    "idempotent_store",
    "ingest_checked",
    "ingest_idempotent",
    "ingest_log",
    "invoice_lines_stream",
    "net_position_report",
    "observed_trades",
    "rewards_accumulated",
    "rewards_complete",
    "rewards_store",
    "rewards_updated",
    "sensor_maximum_stream",
    "trade_summary_stream",
    "updated_sensor_windows",
    "updated_trade_windows",
    "updated_windows",
    "window_store",
    "word_count_stream",
    "word_count_table",
]
