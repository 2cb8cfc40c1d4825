from millrace.operators.invoices import line_items
from millrace.operators.logs import (
    checked_log,
    decode_log,
    distinct_records,
    fingerprint,
    latest_per_key,
    newest_rows,
    sensor_readings,
    split_malformed,
    trade_columns,
    trades,
)
from millrace.operators.nesting import nested
from millrace.operators.reports import (
    peek,
    row_count,
    running_net,
    running_totals,
    total_with_prefix,
    window_rows,
)
from millrace.operators.rewards import as_double, rewards
from millrace.operators.upsert import merge_into, upsert
from millrace.operators.windows import sensor_maximum, trade_summary, window_aggregate
from millrace.operators.words import tokens, word_count

__all__ = [
    "as_double",
    "checked_log",
    "decode_log",
    "distinct_records",
    "fingerprint",
    "latest_per_key",
    "line_items",
    "merge_into",
    "nested",
    "newest_rows",
    "peek",
    "rewards",
    "row_count",
    "running_net",
    "running_totals",
    "sensor_maximum",
    "sensor_readings",
    "split_malformed",
    "tokens",
    "total_with_prefix",
    "trade_columns",
    "trade_summary",
    "trades",
    "upsert",
    "window_aggregate",
    "window_rows",
    "word_count",
]
