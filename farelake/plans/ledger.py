"""Months that Silver and Gold still owe to Bronze.

Bronze is laid out by file month, Silver and Gold by pickup month. Once a file of
Bronze is overwritten, nothing there tells which pickup months the old file had. So a run
writes the months down before it touches Bronze, and strikes them out when Gold is
published. A run that finds months of another that never ended rebuilds them with its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from farelake.sinks.files import remove

#: Year and month, both null for trips without a pickup.
Month = tuple[int | None, int | None]

_ENTRY = "year int, month int, whole boolean"


@dataclass(frozen=True)
class Owed:
    """Entries that were never struck out, and their months; None for all there are."""

    entries: tuple[str, ...]
    months: frozenset[Month] | None


class Ledger:
    """Entries below ``silver_base``, one directory each, so runs never write the same one."""

    def __init__(self, spark: SparkSession, silver_base: str, dataset: str) -> None:
        self._spark = spark
        self._path = f"{silver_base}/_owed/{dataset}"

    def note(self, months: Iterable[Month] | None) -> None:
        """Write months down, or all there are; it is durable when this returns."""
        rows = [(None, None, True)] if months is None else [(y, m, False) for y, m in months]
        entry = self._spark.createDataFrame(rows, _ENTRY).coalesce(1)
        entry.write.parquet(f"{self._path}/entry={uuid.uuid4().hex}")

    def owed(self) -> Owed:
        """What no run has struck out yet."""
        try:
            reader = self._spark.read.schema(f"{_ENTRY}, entry string")
            rows = reader.parquet(self._path).distinct().collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        entries = tuple(sorted({row.entry for row in rows}))
        if any(row.whole for row in rows):
            return Owed(entries, None)
        return Owed(entries, frozenset((row.year, row.month) for row in rows))

    def strike(self, owed: Owed) -> None:
        """Remove entries whose months have been rebuilt; later ones stay."""
        for entry in owed.entries:
            remove(self._spark, f"{self._path}/entry={entry}")
