"""Data-quality scorecard in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The highest share of null and of bad values that still passes.
NULL_LIMIT = 0.05
BAD_LIMIT = 0.02


@dataclass(frozen=True)
class Rule:
    """Rows matching ``where`` are counted; more than ``limit`` of all rows fails."""

    count: str
    rate: str
    where: Column
    limit: float


def default_rules(distance: Column | None = None, fare: Column | None = None) -> list[Rule]:
    """Null and out-of-range distances and fares, of the columns of the contract unless given."""
    distance = F.col("trip_distance") if distance is None else distance
    fare = F.col("fare_amount") if fare is None else fare
    return [
        Rule("null_trip_distance", "rate_null_distance", distance.isNull(), NULL_LIMIT),
        Rule("null_fare_amount", "rate_null_fare", fare.isNull(), NULL_LIMIT),
        Rule("bad_distance", "rate_bad_distance", distance <= 0, BAD_LIMIT),
        Rule("bad_fare", "rate_bad_fare", fare < 0, BAD_LIMIT),
    ]


def counts(rules: Sequence[Rule] | None = None) -> list[Column]:
    """The aggregates a scorecard is made of: all rows, and those of each rule."""
    rules = default_rules() if rules is None else rules
    return [
        F.count("*").alias("rows_total"),
        *[F.count_if(rule.where).alias(rule.count) for rule in rules],
    ]


def profile(
    df: DataFrame, run_id: str, run_epoch: int, rules: Sequence[Rule] | None = None
) -> DataFrame:
    """One row: total, count and rate per rule, and whether every limit holds.

    All rules share one scan. Without rows every rate is 1, so the gate closes.
    """
    return scored(df.agg(*counts(rules)), run_id, run_epoch, rules)


def scored(
    counted: DataFrame, run_id: str, run_epoch: int, rules: Sequence[Rule] | None = None
) -> DataFrame:
    """The scorecard of rows that have been counted by :func:`counts`."""
    rules = default_rules() if rules is None else rules
    total = F.col("rows_total")
    rates = counted.withColumns(
        {r.rate: F.when(total > 0, F.col(r.count) / total).otherwise(F.lit(1.0)) for r in rules}
    )
    passed = reduce(and_, [F.col(r.rate) <= r.limit for r in rules], F.lit(True))
    return rates.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_epoch).cast("bigint").alias("run_epoch"),
        "rows_total",
        *[r.count for r in rules],
        *[r.rate for r in rules],
        passed.cast("int").alias("passed"),
    )
