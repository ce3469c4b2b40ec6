"""Run metrics over Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions.numeric import exact_avg, exact_sum


def summarise_gold(gold: DataFrame, run_id: str, run_epoch: int) -> DataFrame:
    """One row of totals over all months; zeros when there are none.

    The mean distance is the mean of the monthly means, each month counting
    once. Months are counted as (year, month) pairs, the null month included.
    """
    return gold.agg(
        F.count_distinct(F.struct("year", "month")).alias("months_covered"),
        F.count("*").alias("rows_gold"),
        F.sum("trips").cast("double").alias("trips_total"),
        exact_sum("total_fare").alias("fare_total"),
        exact_sum("total_tip").alias("tip_total"),
        exact_avg("avg_distance").alias("avg_distance_over_months"),
    ).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_epoch).cast("bigint").alias("run_epoch"),
        "months_covered",
        "rows_gold",
        *[
            F.coalesce(name, F.lit(0.0)).alias(name)
            for name in ("trips_total", "fare_total", "tip_total", "avg_distance_over_months")
        ],
    )
