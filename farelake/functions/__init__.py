"""Column expressions shared by the operators."""

from farelake.functions.months import (
    dataset_name,
    month_columns,
    month_file_name,
    month_of_name,
    month_path,
)
from farelake.functions.numeric import exact_avg, exact_parts, exact_sum, exact_total
from farelake.functions.times import iso_seconds, parse_timestamp

__all__ = [
    "dataset_name",
    "exact_avg",
    "exact_parts",
    "exact_sum",
    "exact_total",
    "iso_seconds",
    "month_columns",
    "month_file_name",
    "month_of_name",
    "month_path",
    "parse_timestamp",
]
