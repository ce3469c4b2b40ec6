"""Table contracts: column names, order and types of every layer.

Every number in a trip record is a double, identifiers included, because the
integer width of the raw files changes between vintages and double is the one
type all of them fit.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "binary": T.BinaryType(),
}


def contract(columns: str) -> T.StructType:
    """Build a schema from ``"name type"`` pairs separated by commas or newlines."""
    pairs = (item.split() for item in columns.replace("\n", ",").split(",") if item.strip())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, order and types of the published tables and files.

PARTITION = contract("year int, month int")

BRONZE = contract("""
    VendorID double
    tpep_pickup_datetime timestamp
    tpep_dropoff_datetime timestamp
    passenger_count double
    trip_distance double
    RatecodeID double
    store_and_fwd_flag string
    PULocationID double
    DOLocationID double
    payment_type double
    fare_amount double
    extra double
    mta_tax double
    tip_amount double
    tolls_amount double
    improvement_surcharge double
    total_amount double
    congestion_surcharge double
    airport_fee double
""")

SILVER = T.StructType(
    BRONZE.fields + contract("pickup_date date").fields + PARTITION.fields
)

GOLD = T.StructType(
    contract("""
        trips bigint
        total_fare double
        total_tip double
        avg_distance double
    """).fields
    + PARTITION.fields
)

PAYLOAD = contract("""
    tpep_pickup_datetime string
    tpep_dropoff_datetime string
    passenger_count double
    trip_distance double
    fare_amount double
    tip_amount double
    PULocationID double
    DOLocationID double
    payment_type double
""")

ENVELOPE = contract("""
    key binary
    value binary
    topic string
    partition int
    offset bigint
    timestamp timestamp
    timestampType int
""")

FACT_TRIPS_MONTHLY = T.StructType(PARTITION.fields + GOLD.fields[:4])

DQ_RESULTS = contract("""
    run_id string
    run_epoch bigint
    rows_total bigint
    null_trip_distance bigint
    null_fare_amount bigint
    bad_distance bigint
    bad_fare bigint
    rate_null_distance double
    rate_null_fare double
    rate_bad_distance double
    rate_bad_fare double
    passed int
""")

METRICS_PIPELINE_RUNS = contract("""
    run_id string
    run_epoch bigint
    months_covered bigint
    rows_gold bigint
    trips_total double
    fare_total double
    tip_total double
    avg_distance_over_months double
""")

TAXI_ZONE_LOOKUP = contract("""
    location_id int
    borough string
    zone string
    service_zone string
""")

ZONE_CSV = contract("""
    LocationID int
    Borough string
    Zone string
    service_zone string
""")

SERVING_TABLES = {
    "fact_trips_monthly": FACT_TRIPS_MONTHLY,
    "dq_results": DQ_RESULTS,
    "metrics_pipeline_runs": METRICS_PIPELINE_RUNS,
    "taxi_zone_lookup": TAXI_ZONE_LOOKUP,
}

PRIMARY_KEYS = {
    "fact_trips_monthly": ["year", "month"],
    "taxi_zone_lookup": ["location_id"],
}

LATEST_VIEWS = {
    "dq_results": "v_latest_dq",
    "metrics_pipeline_runs": "v_latest_metrics",
}

DEFAULT_DATASET = "yellow_tripdata"
# Messages carry fewer columns than files, so they have months of their own.
TOPIC_DATASET = "yellow_tripdata_topic"
GOLD_TABLE = "kpis_trips_monthly"
