"""Parquet directories partitioned by year and month."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from typing import Literal

from pyspark.sql import DataFrame, SparkSession

from farelake.session import scratch_path
from farelake.sinks.files import remove

#: Files a task keeps open at once; with more directories than these it sorts what is left.
_OPEN_AT_ONCE = 128
_OPEN_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
_CLEAN_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Fixed value: how a null partition value is named in a path.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def spread_by_month(df: DataFrame) -> DataFrame:
    """Rows of a month brought together, in as many tasks as the month is large.

    With a plain hash repartition each month is one task, and a month that holds
    a third of the data decides how long the job takes. AQE splits such a month
    to the advisory partition size and merges small ones.
    """
    return df.hint("rebalance", "year", "month")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def side_by_side(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes in here keep a file open for each directory instead of sorting a task's rows by it.

    What a task holds is then encoded pages, not all its rows. Spark has no option of a
    single write for this. Rows are the same either way, so writes of other threads may see it.
    """
    return _setting(spark, _OPEN_SETTING, str(_OPEN_AT_ONCE))


def cleared(spark: SparkSession) -> AbstractContextManager[None]:
    """What is executed in here leaves none of its shuffle files behind.

    Else they stay on the disks of the executors until the driver happens to collect its garbage, so
    those of one step lie beside those of the next.
    """
    return _setting(spark, _CLEAN_SETTING, "true")


@contextmanager
def staged(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """Rows written to the scratch folder and read from there; in the end they are removed.

    What was shuffled to make them is gone before they are used.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    try:
        with cleared(spark):
            rows.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove(spark, path)


def write_months(df: DataFrame, path: str, replace: Literal["all", "present"]) -> None:
    """Overwrite all months, or only those present in ``df``.

    The mode is set on this write alone, not on the session.
    """
    mode = {"all": "static", "present": "dynamic"}[replace]
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    with side_by_side(df.sparkSession), cleared(df.sparkSession):
        writer.partitionBy("year", "month").parquet(path)


def append_months(df: DataFrame, path: str) -> None:
    """Add rows to their months; each task adds a file to every month it has rows of."""
    with side_by_side(df.sparkSession):
        df.write.mode("append").partitionBy("year", "month").parquet(path)


def month_leaf(path: str, year: int | None, month: int | None, prefix: str = "") -> str:
    """Directory of one month."""
    leaf = "/".join(
        f"{prefix}{name}={_NULL_PARTITION if value is None else value}"
        for name, value in (("year", year), ("month", month))
    )
    return f"{path}/{leaf}"


def write_month(df: DataFrame, path: str, year: int | None, month: int | None) -> str:
    """Overwrite exactly one month without shuffling or sorting; returns its path."""
    leaf = month_leaf(path, year, month)
    df.write.mode("overwrite").parquet(leaf)
    return leaf
