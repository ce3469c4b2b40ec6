"""The naming rule of monthly files, in both directions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# How raw files are named and how a month is found in a name.
MONTH_PATTERN = r"(\d{4})-(\d{2})"
COLORS = ("yellow", "green", "fhv")


def dataset_name(color: str) -> str:
    """Directory and file prefix of one colour."""
    if color not in COLORS:
        raise ValueError(f"color must be one of {', '.join(COLORS)}, not {color!r}")
    return f"{color}_tripdata"


def month_file_name(color: str, year: int, month: int) -> str:
    """Name of the raw file that holds one month of one colour."""
    return f"{dataset_name(color)}_{year}-{month:02d}.parquet"


def month_path(raw_base: str, color: str, year: int, month: int) -> str:
    """Where that raw file lies below ``raw_base``, on any file system Spark reads."""
    return f"{raw_base.rstrip('/')}/{month_file_name(color, year, month)}"


def month_of_name(path: str) -> tuple[int | None, int | None]:
    """Year and month of one path, from the first match in its last segment."""
    found = re.search(MONTH_PATTERN, path.rstrip("/").rsplit("/", 1)[-1])
    return (int(found[1]), int(found[2])) if found else (None, None)


def month_columns(name: Column, prefix: str = "") -> dict[str, Column]:
    """``year`` and ``month`` columns for names held in a column.

    ``prefix`` is a regular expression the month must follow. Names without a
    month give nulls.
    """
    pattern = prefix + MONTH_PATTERN
    return {
        "year": F.regexp_extract(name, pattern, 1).try_cast("int"),
        "month": F.regexp_extract(name, pattern, 2).try_cast("int"),
    }
