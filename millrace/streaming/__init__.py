from millrace.streaming.counts import count_per_batch, print_first, sliding_counts, tumbling_counts, words_of
from millrace.streaming.ledger import Batch, BatchLedger, as_table, listening
from millrace.streaming.lines import stream_growing_lines
from millrace.streaming.runner import append_available, disorder_of, drain_windows, run_available, run_continuously, span_of
from millrace.streaming.slides import running_counts
from millrace.streaming.sources import socket_lines, stream_parquet, stream_text, utc_instant

__all__ = [
    "Batch",
    "BatchLedger",
    "append_available",
    "as_table",
    "count_per_batch",
    "disorder_of",
    "drain_windows",
    "listening",
    "print_first",
    "run_available",
    "run_continuously",
    "running_counts",
    "sliding_counts",
    "socket_lines",
    "span_of",
    "stream_growing_lines",
    "stream_parquet",
    "stream_text",
    "tumbling_counts",
    "utc_instant",
    "words_of",
]
