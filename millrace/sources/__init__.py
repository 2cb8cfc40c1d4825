from millrace.sources.files import (
    csv_rows,
    invoices,
    json_inferred,
    sentences,
    table,
    with_input_file,
)
from millrace.sources.log import envelope_files, from_timestamp, kafka_log, kafka_options

__all__ = [
    "csv_rows",
    "envelope_files",
    "from_timestamp",
    "invoices",
    "json_inferred",
    "kafka_log",
    "kafka_options",
    "sentences",
    "table",
    "with_input_file",
]
