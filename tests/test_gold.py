"""Gold: KPIs, exact sums, publishing."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from helpers import parquet_files, rows, trips_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelake.functions import exact_avg, exact_sum
from farelake.operators import clean_trips, monthly_kpis, pk_violations
from farelake.plans import GoldStatus, build_gold
from farelake.schemas import PRIMARY_KEYS
from farelake.sinks import FileWarehouse, write_months
from farelake.sources import read_gold_or_empty

DATASET = "yellow_tripdata"
QUIET = settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def total(spark, values, column=exact_sum, parts=3):
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return frame.agg(column("x").alias("s")).first().s


@QUIET
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=30))
def test_sum_of_cents_is_exact(spark, cents):
    values = [c / 100 for c in cents]
    assert total(spark, values) == float(sum(Decimal(c) for c in cents) / 100)


def test_sum_ignores_order_where_doubles_do_not(spark):
    values = [0.1, 0.2, 0.3] * 1000 + [1e9 + 0.01] * 7
    results = {total(spark, values, parts=parts) for parts in (1, 3, 7)}
    assert results == {7 * 10**9 + 0.07 + 600.0}


def test_sum_falls_back_to_doubles(spark):
    assert total(spark, [1 / 3, 1.0], parts=1) == 1 / 3 + 1.0
    assert total(spark, [1e300, 1.0]) == 1e300
    nan = total(spark, [float("nan"), 1.0])
    assert nan != nan
    assert total(spark, [float("inf"), 1.0]) == float("inf")
    assert total(spark, [9e14] * 3) == 2.7e15


def test_sum_and_mean_of_nothing_are_null(spark):
    assert total(spark, [None, None]) is None
    assert total(spark, [], exact_avg) is None
    assert total(spark, [1.0, None, 2.0], exact_avg) == 1.5


def test_kpis_round_half_up_and_keep_the_null_month(spark):
    trips = trips_frame(
        spark,
        [
            ("2023-01-01T00:00:00", 1.005, 10.125, 0.0),
            ("2023-02-01T00:00:00", 1.0, 1.0, None),
            (None, 3.0, 7.0, 1.0),
        ],
    )
    assert rows(monthly_kpis(clean_trips(trips))) == [
        (2023, 1, 1, 10.13, 0.0, 1.01),
        (2023, 2, 1, 1.0, None, 1.0),
        (None, None, 1, 7.0, 1.0, 3.0),
    ]


def silver_of(spark, base, trips):
    frame = clean_trips(trips_frame(spark, trips)).repartition(5)
    write_months(frame, f"{base}/silver/{DATASET}", replace="all")


def test_build_writes_one_file_per_month_and_publishes(spark, base):
    silver_of(
        spark,
        base,
        [(f"2023-{m:02d}-03T00:00:00", 1.0, 2.0, 0.5) for m in range(1, 13) for _ in range(4)],
    )
    warehouse = FileWarehouse(f"{base}/warehouse")
    assert build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse) is GoldStatus.WRITTEN
    assert len(parquet_files(f"{base}/gold")) == 12
    published = warehouse.read(spark, "fact_trips_monthly")
    assert published.columns == ["year", "month", "trips", "total_fare", "total_tip", "avg_distance"]
    assert rows(published)[0] == (2023, 1, 4, 8.0, 2.0, 1.0)
    assert pk_violations(published, PRIMARY_KEYS["fact_trips_monthly"]).isEmpty()
    first = rows(published)
    build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse)
    assert rows(warehouse.read(spark, "fact_trips_monthly")) == first


def test_empty_silver_leaves_gold_alone(spark, base):
    silver_of(spark, base, [("2023-01-01T00:00:00", 1.0, 2.0, 0.5)])
    warehouse = FileWarehouse(f"{base}/warehouse")
    build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse)
    before = rows(read_gold_or_empty(spark, f"{base}/gold"))
    silver_of(spark, base, [])
    assert build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse) is GoldStatus.SILVER_EMPTY
    assert rows(read_gold_or_empty(spark, f"{base}/gold")) == before
    os.makedirs(f"{base}/bare/{DATASET}")
    assert build_gold(spark, f"{base}/bare", f"{base}/gold", warehouse) is GoldStatus.SILVER_EMPTY


def test_one_value_that_is_no_multiple_leaves_the_rest_exact(spark):
    values = [0.1, 0.2, 0.3] * 1000 + [1 / 3] + [1e9 + 0.01] * 7
    results = {total(spark, values, parts=parts) for parts in (1, 7, 64)}
    assert results == {7 * 10**9 + 0.07 + 600.0 + 1 / 3}


def test_units_beyond_a_bigint_stop_the_query(spark):
    with pytest.raises(Exception, match="beyond a bigint"):
        total(spark, [8e11] * 2000)


def test_a_null_month_leaves_the_table_unless_it_is_given_one(spark, base):
    warehouse = FileWarehouse(f"{base}/warehouse")
    silver_of(spark, base, [("2023-01-01T00:00:00", 1.0, 2.0, 0.5)])
    build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse)
    before = rows(warehouse.read(spark, "fact_trips_monthly"))
    silver_of(spark, base, [(None, 1.0, 2.0, 0.5), ("2023-01-01T00:00:00", 1.0, 2.0, 0.5)])
    with pytest.raises(ValueError, match="1 null"):
        build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse)
    assert rows(warehouse.read(spark, "fact_trips_monthly")) == before
    build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse, undated=(1900, 1))
    assert rows(warehouse.read(spark, "fact_trips_monthly"))[0][:3] == (1900, 1, 1)


def test_keys_are_checked_before_a_database_is_touched(spark, monkeypatch):
    from farelake.sinks import JdbcWarehouse

    monkeypatch.setattr("pyspark.sql.DataFrameWriter.save", lambda *a, **k: pytest.fail("wrote"))
    schema = "year int, month int, trips bigint, total_fare double, total_tip double, avg_distance double"
    for data in ([(None, 1, 1, 1.0, 1.0, 1.0)], [(2023, 1, 1, 1.0, 1.0, 1.0)] * 2):
        with pytest.raises(ValueError):
            JdbcWarehouse("jdbc:x", "u", "p").replace(spark.createDataFrame(data, schema), "fact_trips_monthly")


def test_trips_of_gold_are_rows_of_silver(spark):
    silver = clean_trips(trips_frame(spark, [(None, 1.0, 1.0, 1.0), ("2023-01-01T00:00:00", 2.0, 1.0, 1.0)]))
    assert monthly_kpis(silver).agg(F.sum("trips")).first()[0] == silver.count()
