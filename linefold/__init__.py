"""linefold: summarise delimited transaction logs with Spark, in batch and as a stream."""

from linefold.config import FieldSpec, KafkaSpec, LogSpec, SummarySpec
from linefold.operators.parse import accepted, parse, parse_accepted, rejects
from linefold.operators.summary import apply_predicate, count_by, preview, rollup_counts, row_count, summarize
from linefold.sinks.batch_table import BatchTable
from linefold.sinks.ledger import SummaryLedger
from linefold.sinks.tables import SummaryTable
from linefold.sources.lines import read_lines, record_values, stream_lines
from linefold.streaming.jobs import (
    CheckpointError,
    run_bounded,
    start_archive,
    start_batch_counts,
    start_console_preview,
    start_offset_report,
    start_running_total,
    start_summary_stream,
)

__all__ = [
    "BatchTable",
    "CheckpointError",
    "FieldSpec",
    "KafkaSpec",
    "LogSpec",
    "SummaryLedger",
    "SummarySpec",
    "SummaryTable",
    "accepted",
    "apply_predicate",
    "count_by",
    "parse",
    "parse_accepted",
    "preview",
    "read_lines",
    "record_values",
    "rejects",
    "rollup_counts",
    "row_count",
    "run_bounded",
    "start_archive",
    "start_batch_counts",
    "start_console_preview",
    "start_offset_report",
    "start_running_total",
    "start_summary_stream",
    "stream_lines",
    "summarize",
]
