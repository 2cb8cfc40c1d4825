from millrace.streaming.folders import stored_bytes
from millrace.streaming.metrics import Metrics, listening, observed
from millrace.streaming.sinks import (
    append,
    changed_groups,
    complete,
    overwrite_table,
    raw_batches,
    table_saver,
)
from millrace.streaming.state import state_operators, state_rows, watermark
from millrace.streaming.stores import Snapshots, UpsertStore

__all__ = [
    "Metrics",
    "Snapshots",
    "UpsertStore",
    "append",
    "changed_groups",
    "complete",
    "listening",
    "observed",
    "overwrite_table",
    "raw_batches",
    "state_operators",
    "state_rows",
    "stored_bytes",
    "table_saver",
    "watermark",
]
