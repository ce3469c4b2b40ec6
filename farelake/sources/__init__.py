"""Readers of every layer."""

from farelake.sources.csv import read_zone_csv
from farelake.sources.footers import footers
from farelake.sources.parquet import (
    below,
    file_sizes,
    first_rows,
    raw_inputs,
    read_bronze,
    read_bronze_month,
    read_gold,
    read_gold_or_empty,
    read_inputs,
    read_mixed,
    read_raw,
    read_silver,
    scanned_path,
    schema_groups,
    skipped_files,
)

__all__ = [
    "below",
    "file_sizes",
    "first_rows",
    "footers",
    "raw_inputs",
    "read_bronze",
    "read_bronze_month",
    "read_gold",
    "read_gold_or_empty",
    "read_inputs",
    "read_mixed",
    "read_raw",
    "read_silver",
    "read_zone_csv",
    "scanned_path",
    "schema_groups",
    "skipped_files",
]
