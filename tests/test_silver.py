"""Silver: filters, dating, layout."""

from __future__ import annotations

from helpers import by_file_month, parquet_files, rows, trips_frame

from farelake.operators import clean_trips
from farelake.plans import build_silver
from farelake.schemas import SILVER
from farelake.sinks import write_months
from farelake.sources import read_silver

DATASET = "yellow_tripdata"
DAY = "2023-01-15T10:00:00"


def test_distance_must_be_positive_and_nan_stays(spark):
    nan = float("nan")
    trips = trips_frame(spark, [(DAY, d, 1.0, 0.0) for d in (nan, None, 0.0, -1.0, 2.0)])
    kept = [r.trip_distance for r in clean_trips(trips).collect()]
    assert len(kept) == 2 and 2.0 in kept and any(d != d for d in kept)


def test_fare_may_be_zero(spark):
    trips = trips_frame(spark, [(DAY, 1.0, f, 0.0) for f in (None, -0.01, 0.0, 5.0)])
    assert sorted(r.fare_amount for r in clean_trips(trips).collect()) == [0.0, 5.0]


def test_month_is_that_of_the_pickup(spark):
    trips = by_file_month(
        trips_frame(spark, [("2022-12-31T23:59:59", 1.0, 1.0, 0.0), (None, 1.0, 1.0, 0.0)]), 2023, 1
    )
    silver = clean_trips(trips)
    assert set(silver.columns) == set(SILVER.names)
    assert rows(silver.select("year", "month")) == [(2022, 12), (None, None)]


def write_two_months(spark, base):
    january = [(f"2023-01-{d:02d}T08:00:00", 1.0, 1.0, 0.5) for d in range(1, 11)]
    february = [
        ("2023-02-01T00:00:00", 2.0, 2.0, 0.5),
        ("2023-01-31T23:00:00", 3.0, 3.0, 0.5),
        (None, 4.0, 4.0, 0.5),
        ("2023-02-02T00:00:00", 0.0, 2.0, 0.5),
    ]
    for month, trips in ((1, january), (2, february)):
        frame = by_file_month(trips_frame(spark, trips), 2023, month)
        write_months(frame, f"{base}/bronze/{DATASET}", replace="present")


def test_build_moves_strays_to_their_month(spark, base):
    write_two_months(spark, base)
    build_silver(spark, f"{base}/bronze", f"{base}/silver")
    silver = read_silver(spark, f"{base}/silver")
    assert silver.schema.names == SILVER.names
    assert rows(silver.groupBy("year", "month").count()) == [
        (2023, 1, 11),
        (2023, 2, 1),
        (None, None, 1),
    ]


def test_build_again_gives_the_same_and_drops_gone_months(spark, base):
    write_two_months(spark, base)
    build_silver(spark, f"{base}/bronze", f"{base}/silver")
    first = rows(read_silver(spark, f"{base}/silver"))
    build_silver(spark, f"{base}/bronze", f"{base}/silver")
    assert rows(read_silver(spark, f"{base}/silver")) == first
    only_march = by_file_month(trips_frame(spark, [("2023-03-01T00:00:00", 1.0, 1.0, 0.0)]), 2023, 3)
    write_months(only_march, f"{base}/bronze/{DATASET}", replace="all")
    build_silver(spark, f"{base}/bronze", f"{base}/silver")
    assert rows(read_silver(spark, f"{base}/silver").select("year", "month")) == [(2023, 3)]


def test_hot_month_is_split_over_tasks(spark, base):
    from pyspark.sql import functions as F

    from farelake.sinks import spread_by_month

    ids = spark.range(0, 200_000, 1, 16)
    frame = ids.select(
        "id",
        F.expr("md5(cast(id AS string))").alias("text"),
        F.lit(2023).alias("year"),
        F.when(F.col("id") < 190_000, 1).otherwise(2).alias("month"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        write_months(spread_by_month(frame), base, replace="all")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(parquet_files(f"{base}/year=2023/month=1")) > 4
    assert len(parquet_files(f"{base}/year=2023/month=2")) <= 2
    assert spark.read.parquet(base).count() == 200_000


def test_pickup_column_of_another_dataset(spark, base):
    from helpers import when

    from farelake.sinks import write_month

    raw = spark.createDataFrame(
        [(when("2023-04-02T00:00:00"), 1.0, 1.0)],
        "lpep_pickup_datetime timestamp_ntz, trip_distance double, fare_amount double",
    )
    write_month(raw, f"{base}/bronze/green_tripdata", 2023, 4)
    build_silver(spark, f"{base}/bronze", f"{base}/silver", "green_tripdata", "lpep_pickup_datetime")
    silver = read_silver(spark, f"{base}/silver", "green_tripdata")
    assert rows(silver.select("tpep_pickup_datetime", "year", "month")) == [
        (when("2023-04-02T00:00:00"), 2023, 4)
    ]
