"""Composable PySpark operators for exploring and modelling tables at scale."""

from insight.functions import Range, elapsed, encode_label
from insight.operators import *  # noqa: F403
from insight.operators import __all__ as _operators
from insight.plans import AnalysisPlan, run_analyses, trip_plan
from insight.sources import read_table, sample_rows, write_report, write_sample

__all__ = [
    *_operators,
    "AnalysisPlan",
    "Range",
    "elapsed",
    "encode_label",
    "read_table",
    "run_analyses",
    "sample_rows",
    "trip_plan",
    "write_report",
    "write_sample",
]
