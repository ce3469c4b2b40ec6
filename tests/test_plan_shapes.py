"""What reaches the scan, how often it runs, and what is shuffled."""

from __future__ import annotations

import re

import pytest
from helpers import by_file_month, plan, trips_frame
from pyspark.sql import functions as F

from farelake.operators import (
    clean_trips,
    monthly_kpis,
    months_of_year,
    profile,
    recent_months,
    row_counts,
    summarise_gold,
)
from farelake.sinks import write_month, write_months
from farelake.sources import read_bronze, read_gold_or_empty, read_silver
from farelake.streaming import decode_trips, encode
from workload import tables

SF_DIR = "/root/testdata/sf0.001"
DATASET = "yellow_tripdata"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    trips = trips_frame(spark, [("2023-01-01T00:00:00", 1.0, 1.0, 1.0)])
    write_months(by_file_month(trips, 2023, 1), f"{base}/{DATASET}", replace="all")
    silver = clean_trips(read_bronze(spark, base))
    write_months(silver, f"{base}/silver/{DATASET}", replace="all")
    write_months(monthly_kpis(silver), f"{base}/kpis_trips_monthly", replace="all")
    return base


def scans(text):
    return len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M))


def read_columns(text):
    return [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def test_silver_filters_reach_the_scan(spark, lake, capsys):
    text = plan(clean_trips(read_bronze(spark, lake)), capsys)
    assert "GreaterThan(trip_distance,0.0)" in text
    assert "GreaterThanOrEqual(fare_amount,0.0)" in text
    assert "Batched: true" in text and "Exchange" not in text


def test_kpis_read_three_columns_and_aggregate_before_the_shuffle(spark, lake, capsys):
    text = plan(monthly_kpis(read_silver(spark, f"{lake}/silver")), capsys)
    assert read_columns(text) == [{"trip_distance", "fare_amount", "tip_amount"}]
    assert text.count("Exchange") == 2 and "partial_count(1)" in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_profile_is_one_scan_of_two_columns(spark, lake, capsys):
    text = plan(profile(read_silver(spark, f"{lake}/silver"), "a", 1), capsys)
    assert scans(text) == 1
    assert read_columns(text) == [{"trip_distance", "fare_amount"}]


def test_metrics_are_one_scan(spark, lake, capsys):
    assert scans(plan(summarise_gold(read_gold_or_empty(spark, lake), "a", 1), capsys)) == 1


def test_one_year_reads_its_directories(spark, lake, capsys):
    text = plan(months_of_year(read_gold_or_empty(spark, lake), 2023), capsys)
    assert re.search(r"PartitionFilters: \[.*year#\d+ = 2023", text)


def test_counts_read_no_column(spark, lake, capsys):
    text = plan(row_counts({"silver": read_silver(spark, f"{lake}/silver")}), capsys)
    assert "ReadSchema: struct<>" in text


def test_recent_months_need_no_full_sort(spark, lake, capsys):
    text = plan(recent_months(read_gold_or_empty(spark, lake)), capsys)
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_drifting_months_are_one_scan_per_schema(spark, base, capsys):
    for month in range(1, 7):
        kind = "bigint" if month % 2 else "double"
        frame = spark.createDataFrame([(1.0,)], "trip_distance double").withColumn(
            "VendorID", F.lit(month).cast(kind)
        )
        write_month(frame, f"{base}/{DATASET}", 2023, month)
    bronze = read_bronze(spark, base)
    text = plan(bronze.where("trip_distance > 0"), capsys)
    assert scans(text) == 2 and text.count("GreaterThan(trip_distance,0.0)") == 2
    assert bronze.count() == 6


def test_messages_are_parsed_once_per_row(spark, capsys):
    trips = tables.trips(spark, SF_DIR)
    assert plan(decode_trips(encode(trips)), capsys).count("from_json") == 1


def test_no_python_in_any_query(spark, capsys):
    frames = [
        tables.gold(spark, SF_DIR),
        decode_trips(encode(tables.trips(spark, SF_DIR))),
        profile(tables.trips(spark, SF_DIR), "a", 1),
    ]
    for frame in frames:
        text = plan(frame, capsys)
        assert "Python" not in text and "ArrowEval" not in text and "CartesianProduct" not in text


def test_fixture_quantities(spark):
    row = profile(tables.trips(spark, SF_DIR), "a", 1).first()
    assert tuple(row)[2:7] == (6000, 128, 170, 93, 145) and row.passed == 0
    silver = tables.silver(spark, SF_DIR)
    assert silver.count() == 5501 and profile(silver, "a", 1).first().passed == 1
    gold = tables.gold(spark, SF_DIR)
    assert gold.count() == 84
    assert round(gold.agg(F.sum("total_fare")).first()[0], 2) == 290_325_600.24
