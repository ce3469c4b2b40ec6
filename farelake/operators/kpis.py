"""Silver to Gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions.numeric import exact_avg, exact_parts, exact_sum, exact_total


def monthly_kpis(trips: DataFrame, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Trips, fares, tips and mean distance per group; the null month is a group.

    Each task first reduces its rows to one per group, so a month that holds
    most of the data shuffles no more than any other.
    """
    # The names of the KPIs and their two decimals.
    return trips.groupBy(*by).agg(
        F.count("*").alias("trips"),
        F.round(exact_sum("fare_amount"), 2).alias("total_fare"),
        F.round(exact_sum("tip_amount"), 2).alias("total_tip"),
        F.round(exact_avg("trip_distance"), 2).alias("avg_distance"),
    )


#: What a state keeps of each measure, and the KPI it becomes.
_MEASURES = {"fare": "fare_amount", "tip": "tip_amount", "distance": "trip_distance"}


def monthly_state(trips: DataFrame, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """What the KPIs of some trips are made of: counts and sums that can be added up.

    States of any parts of the trips, merged, give the KPIs of all of them to the last digit
    wherever :func:`exact_sum` is exact.
    """
    measures = []
    for name, column in _MEASURES.items():
        units, rest = exact_parts(column)
        measures += [units.alias(f"{name}_units"), rest.alias(f"{name}_rest")]
    return trips.groupBy(*by).agg(
        F.count("*").alias("trips"), F.count("trip_distance").alias("distances"), *measures
    )


def merged_kpis(states: DataFrame, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """The KPIs of :func:`monthly_kpis` from states of parts of the trips."""

    def total(name: str):
        return exact_total(F.sum(f"{name}_units"), F.sum(f"{name}_rest"))

    known = F.sum("distances")
    return states.groupBy(*by).agg(
        F.sum("trips").alias("trips"),
        F.round(total("fare"), 2).alias("total_fare"),
        F.round(total("tip"), 2).alias("total_tip"),
        F.round(F.when(known > 0, total("distance") / known), 2).alias("avg_distance"),
    )
