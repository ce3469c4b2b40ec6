"""Queries over the published tables: latest runs, recent months, validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_runs(runs: DataFrame, n: int) -> DataFrame:
    """The last ``n`` runs; runs of the same second are ordered by their id."""
    return runs.orderBy(F.desc("run_epoch"), F.desc("run_id")).limit(n)


def latest_run(runs: DataFrame) -> DataFrame:
    """The last run."""
    return recent_runs(runs, 1)


def failed_runs(runs: DataFrame) -> DataFrame:
    """Runs that did not pass the quality gate."""
    return runs.where(F.col("passed") == 0)


def recent_months(gold: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` months, newest first."""
    return gold.orderBy(F.desc("year"), F.desc("month")).limit(n)


def months_of_year(gold: DataFrame, year: int) -> DataFrame:
    """Months of one year; on a partitioned table only their directories are read."""
    return gold.where(F.col("year") == year)


def row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its number of rows; Parquet answers from its footers."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def null_kpis(gold: DataFrame) -> DataFrame:
    """How many KPI rows lack a year, a month or a number of trips."""
    return gold.agg(
        F.count_if(F.col("year").isNull()).alias("null_years"),
        F.count_if(F.col("month").isNull()).alias("null_months"),
        F.count_if(F.col("trips").isNull()).alias("null_trips"),
    )


def negative_kpis(kpis: DataFrame) -> DataFrame:
    """KPI rows with a negative total."""
    return kpis.where((F.col("total_fare") < 0) | (F.col("total_tip") < 0))


def outlier_months(gold: DataFrame, factor: float = 3) -> DataFrame:
    """Months with more than ``factor`` times the mean number of trips, largest first."""
    limit = gold.agg(F.avg("trips") * factor).scalar()
    return gold.where(F.col("trips") > limit).orderBy(F.desc("trips"), "year", "month")


def reconcile(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows per layer, rows rejected on the way, and whether Gold counts all of Silver."""
    amounts = [
        bronze.agg(F.count("*").alias("n")).select(F.lit("bronze_rows").alias("amount"), "n"),
        silver.agg(F.count("*").alias("n")).select(F.lit("silver_rows").alias("amount"), "n"),
        gold.agg(F.coalesce(F.sum("trips"), F.lit(0)).alias("n")).select(
            F.lit("gold_trips").alias("amount"), "n"
        ),
    ]
    bronze_rows, silver_rows, gold_trips = (
        F.sum(F.when(F.col("amount") == name, F.col("n")))
        for name in ("bronze_rows", "silver_rows", "gold_trips")
    )
    return reduce(DataFrame.unionByName, amounts).agg(
        bronze_rows.alias("bronze_rows"),
        silver_rows.alias("silver_rows"),
        (bronze_rows - silver_rows).alias("rejected_rows"),
        gold_trips.alias("gold_trips"),
        (silver_rows == gold_trips).alias("ok"),
    )


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with how many rows hold them.

    Repeats are counted within each task first, so a key repeated in most rows
    shuffles one row per task.
    """
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
