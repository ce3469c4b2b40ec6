"""The given tables seen as trips, messages, run records and zones.

Nulls, zeros and negative amounts are put in at fixed keys, so that every filter
and quality rule has rows to act on. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.operators import clean_trips, conform, monthly_kpis
from farelake.schemas import BRONZE
from farelake.sinks import side_by_side, write_months

RUN_ID = "run-0001"
RUN_EPOCH = 1_700_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def raw_trips(lineitem: DataFrame) -> DataFrame:
    """Line items as raw trip records with natural types, and the month of their file."""
    pickup = F.col("l_shipdate").cast("timestamp")
    distance = F.when(_every("l_partkey", 41), 0.0).otherwise(F.col("l_quantity"))
    fare = F.when(_every("l_partkey", 37), -F.col("l_extendedprice")).otherwise(
        F.col("l_extendedprice")
    )
    return lineitem.select(
        (F.col("l_suppkey") % 2 + 1).alias("VendorID"),
        F.when(~_every("l_orderkey", 97), pickup).alias("tpep_pickup_datetime"),
        pickup.alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.when(~_every("l_partkey", 50), distance).alias("trip_distance"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        (F.col("l_partkey") % 265 + 1).alias("PULocationID"),
        (F.col("l_suppkey") % 265 + 1).alias("DOLocationID"),
        F.col("l_linenumber").alias("payment_type"),
        F.when(~_every("l_partkey", 43), fare).alias("fare_amount"),
        (F.col("l_quantity") * F.col("l_tax")).alias("tip_amount"),
        F.col("l_partkey").alias("part_key"),
        F.year("l_shipdate").alias("file_year"),
        F.month("l_shipdate").alias("file_month"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as trips under the Bronze contract, by month of their file."""
    raw = raw_trips(table(spark, sf_dir, "lineitem"))
    return conform(raw, BRONZE, keep=["file_year", "file_month"]).withColumnsRenamed(
        {"file_year": "year", "file_month": "month"}
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as Silver."""
    return clean_trips(trips(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as Gold."""
    return monthly_kpis(silver(spark, sf_dir))


def write_bronze(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Trips as Bronze months below ``base``."""
    by_month = trips(spark, sf_dir).hint("rebalance", "year", "month")
    write_months(by_month, f"{base}/yellow_tripdata", replace="all")


def write_raw(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Trips as one raw input per month below ``base``, named like monthly files."""
    raw = raw_trips(table(spark, sf_dir, "lineitem"))
    name = F.format_string(
        "yellow_tripdata_%d-%02d.parquet", F.col("file_year"), F.col("file_month")
    )
    named = raw.withColumn("raw", name).drop("part_key", "file_year", "file_month")
    with side_by_side(spark):
        named.hint("rebalance", "raw").write.partitionBy("raw").parquet(base)


def write_one_raw(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All trips as one raw input."""
    raw = raw_trips(table(spark, sf_dir, "lineitem"))
    raw.drop("part_key", "file_year", "file_month").write.parquet(path)


def envelope(values: DataFrame) -> DataFrame:
    """Messages in ``value`` with the rest of the envelope a topic read gives."""
    return values.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("trips_raw").alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages on a topic of three partitions."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as run records; errors did not pass."""
    epoch = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        epoch.alias("run_epoch"),
        F.col("user_id").alias("rows_total"),
        F.col("value").alias("trips_total"),
        (F.col("event_type") != "error").cast("int").alias("passed"),
    )
