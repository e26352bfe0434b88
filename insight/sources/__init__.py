"""Sources and sinks."""

from insight.sources.local import local_table, settled
from insight.sources.scratch import scratch_folder
from insight.sources.tables import read_table, sample_rows, write_report, write_sample

__all__ = [
    "scratch_folder",
    "local_table",
    "read_table",
    "sample_rows",
    "settled",
    "write_report",
    "write_sample",
]
