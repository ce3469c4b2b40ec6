"""Gold from states: what the KPIs are made of, kept for each file month of Bronze.

A state holds, for each pickup month of one Bronze month, counts and exact sums. Gold is the states
added up: a few rows however many trips there are. A new or replaced file is read once, for its
own state; no month of Silver is read again for it, and Silver is not needed at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farelake.functions.months import month_of_name
from farelake.operators import clean_trips, merged_kpis, monthly_state
from farelake.operators.clean import PICKUP
from farelake.plans.jobs import (
    GoldStatus,
    dated_in,
    ingest_bronze,
    publish_gold,
    replace_months,
)
from farelake.plans.ledger import Ledger, Month
from farelake.schemas import DEFAULT_DATASET, GOLD_TABLE
from farelake.sinks import Warehouse, exists, month_leaf, write_months
from farelake.sources import read_bronze, read_bronze_month, read_gold

_FILE_MONTH = ["file_year", "file_month"]


def _base(gold_base: str, dataset: str) -> str:
    return f"{gold_base}/_state/{dataset}"


def build_states(
    spark: SparkSession,
    bronze_base: str,
    gold_base: str,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
) -> None:
    """The states of all file months, in one pass over Bronze."""
    bronze = read_bronze(spark, bronze_base, dataset, rename={pickup: PICKUP})
    trips = clean_trips(bronze.withColumnsRenamed({"year": "file_year", "month": "file_month"}))
    states = monthly_state(trips, [*_FILE_MONTH, "year", "month"])
    writer = states.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*_FILE_MONTH).parquet(_base(gold_base, dataset))


def write_state(
    spark: SparkSession,
    bronze_base: str,
    gold_base: str,
    month: Month,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
) -> None:
    """The state of one file month, from its directory of Bronze alone."""
    leaf = month_leaf(f"{bronze_base}/{dataset}", *month)
    trips = clean_trips(read_bronze_month(spark, leaf, rename={pickup: PICKUP}))
    state = monthly_state(trips)
    state.write.mode("overwrite").parquet(month_leaf(_base(gold_base, dataset), *month, "file_"))


def read_states(
    spark: SparkSession, gold_base: str, dataset: str = DEFAULT_DATASET
) -> DataFrame:
    """All states, with the file month each is of."""
    base = _base(gold_base, dataset)
    fields = "year int, month int, trips bigint, distances bigint"
    for name in ("fare", "tip", "distance"):
        fields += f", {name}_units bigint, {name}_rest double"
    schema = T.StructType.fromDDL(f"{fields}, file_year int, file_month int")
    return spark.read.schema(schema).option("basePath", base).parquet(base)


def merge_states(
    spark: SparkSession,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    undated: Month | None = None,
) -> GoldStatus:
    """Gold and the serving table from all states. Without trips Gold is left as it is.

    Only months of Gold whose KPIs changed are written; all it takes to tell is a row a month.
    """
    kpis = merged_kpis(read_states(spark, gold_base, dataset))
    if kpis.isEmpty():
        return GoldStatus.SILVER_EMPTY
    path = f"{gold_base}/{GOLD_TABLE}"
    if not exists(spark, path):
        write_months(kpis, path, replace="all")
    else:
        stored = read_gold(spark, gold_base).select(*kpis.columns)
        changed, gone = kpis.exceptAll(stored), stored.exceptAll(kpis)
        new, old = ({(r.year, r.month) for r in rows.collect()} for rows in (changed, gone))
        if new or old:
            replace_months(spark, kpis.where(dated_in(new)), path, new | old)
    publish_gold(spark, gold_base, warehouse, undated)
    return GoldStatus.WRITTEN


def run_states(
    spark: SparkSession,
    input_path: str,
    bronze_base: str,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
    undated: Month | None = None,
) -> GoldStatus:
    """One raw month into Bronze, its state beside Gold, and Gold from all states.

    The file month is written down first, so a run that ends early is made up for by
    the next. Where there are no states yet, those of all Bronze are built.
    """
    ledger = Ledger(spark, gold_base, dataset)
    first = not exists(spark, _base(gold_base, dataset))
    ledger.note(None if first else {month_of_name(input_path)})
    ingest_bronze(spark, input_path, bronze_base, dataset)
    owed = ledger.owed()
    if owed.months is None:
        build_states(spark, bronze_base, gold_base, dataset, pickup)
    for month in sorted(owed.months or (), key=str):
        if exists(spark, month_leaf(f"{bronze_base}/{dataset}", *month)):
            write_state(spark, bronze_base, gold_base, month, dataset, pickup)
    status = merge_states(spark, gold_base, warehouse, dataset, undated)
    if status is GoldStatus.WRITTEN:
        ledger.strike(owed)
    return status
