"""Many small files of a month into few of a planned size."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.plans.jobs import dated_in
from farelake.plans.ledger import Month
from farelake.schemas import DEFAULT_DATASET
from farelake.sinks import write_months
from farelake.sources import file_sizes, read_silver

#: Bytes a file is meant to have, as many as a task reads by default.
TARGET = 128 << 20


class Small(NamedTuple):
    """A month that has files of less than half the target beside another, and its bytes."""

    month: Month
    files: int
    size: int


def small_months(
    spark: SparkSession, silver_base: str, dataset: str = DEFAULT_DATASET, target: int = TARGET
) -> list[Small]:
    """Months worth rewriting: two files or more, one of them below half the target.

    Sizes come from the listing; no file is opened. A month is one row.
    """
    files = file_sizes(spark, f"{silver_base}/{dataset}")
    months = files.groupBy("year", "month").agg(
        F.count("*").alias("files"), F.sum("size").alias("size"), F.min("size").alias("least")
    )
    found = months.where((F.col("files") > 1) & (F.col("least") < target // 2)).collect()
    rows = [Small((row.year, row.month), row.files, row.size) for row in found]
    return sorted(rows, key=lambda row: str(row.month))


def _packed(rows: DataFrame, bins: dict[Month, int]) -> DataFrame:
    """Rows brought together by month and bin; a month has as many bins as files to come.

    The bin follows from where a row lies now, so a task that is tried again deals alike.
    """
    number = F.lit(1)
    for (year, month), n in bins.items():
        here = F.col("year").eqNullSafe(F.lit(year).cast("int")) & F.col("month").eqNullSafe(
            F.lit(month).cast("int")
        )
        number = F.when(here, n).otherwise(number)
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    binned = rows.withColumn("bin", F.pmod(place, number))
    return binned.repartition(max(1, sum(bins.values())), "year", "month", "bin").drop("bin")


def compact_silver(
    spark: SparkSession, silver_base: str, dataset: str = DEFAULT_DATASET, target: int = TARGET
) -> list[Small]:
    """Rewrite the months of Silver whose files are too small; returns them as they were.

    A month gets as many files as it holds targets, one at least, so none is below the
    target unless the month is. Each is overwritten as a whole from its own rows, staged
    first; other months are not read. Silver as a table stays the same.
    """
    found = small_months(spark, silver_base, dataset, target)
    if not found:
        return []
    bins = {row.month: max(1, row.size // target) for row in found}
    rows = read_silver(spark, silver_base, dataset).where(dated_in(set(bins)))
    write_months(_packed(rows, bins), f"{silver_base}/{dataset}", replace="present")
    return found
