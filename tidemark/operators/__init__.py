"""Relational operators, generic in column names. Each one maps DataFrames to a DataFrame."""

from tidemark.operators.aggregate import daily_averages, group_totals, pivot_max
from tidemark.operators.calendar import attach_calendar, date_bounds, date_dim, date_dim_for
from tidemark.operators.conform import conform
from tidemark.operators.incremental import (
    IncrementalTable,
    insert_if_absent,
    late_data_report,
    read_watermark,
    replace_matching,
    watermark_filter,
)
from tidemark.operators.keys import anti_join_keys, distinct_keys
from tidemark.operators.latest import latest_per_day, latest_per_group
from tidemark.operators.runs import (
    append_error_log,
    append_run_log,
    error_count,
    latest_attempts,
    run_log_rows,
    run_summary,
    run_summary_wide,
    run_verdict,
)

__all__ = [
    "IncrementalTable",
    "anti_join_keys",
    "append_error_log",
    "append_run_log",
    "attach_calendar",
    "conform",
    "daily_averages",
    "date_bounds",
    "date_dim",
    "date_dim_for",
    "distinct_keys",
    "error_count",
    "group_totals",
    "insert_if_absent",
    "late_data_report",
    "latest_attempts",
    "latest_per_day",
    "latest_per_group",
    "pivot_max",
    "read_watermark",
    "replace_matching",
    "run_log_rows",
    "run_summary",
    "run_summary_wide",
    "run_verdict",
    "watermark_filter",
]
