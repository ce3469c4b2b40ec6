"""The same results in SQL over the given tables.

Money is summed as decimals. Means are rounded as decimals, which rounds halves
away from zero as Spark does.
"""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT
    CAST(l_suppkey % 2 + 1 AS DOUBLE) AS VendorID,
    CASE WHEN l_orderkey % 97 <> 0 THEN l_shipdate END AS tpep_pickup_datetime,
    l_shipdate AS tpep_dropoff_datetime,
    CAST(l_linenumber AS DOUBLE) AS passenger_count,
    CASE WHEN l_partkey % 50 = 0 THEN NULL
         WHEN l_partkey % 41 = 0 THEN 0.0
         ELSE l_quantity END AS trip_distance,
    CAST(NULL AS DOUBLE) AS RatecodeID,
    l_returnflag AS store_and_fwd_flag,
    CAST(l_partkey % 265 + 1 AS DOUBLE) AS PULocationID,
    CAST(l_suppkey % 265 + 1 AS DOUBLE) AS DOLocationID,
    CAST(l_linenumber AS DOUBLE) AS payment_type,
    CASE WHEN l_partkey % 43 = 0 THEN NULL
         WHEN l_partkey % 37 = 0 THEN -l_extendedprice
         ELSE l_extendedprice END AS fare_amount,
    CAST(NULL AS DOUBLE) AS extra,
    CAST(NULL AS DOUBLE) AS mta_tax,
    l_quantity * l_tax AS tip_amount,
    CAST(NULL AS DOUBLE) AS tolls_amount,
    CAST(NULL AS DOUBLE) AS improvement_surcharge,
    CAST(NULL AS DOUBLE) AS total_amount,
    CAST(NULL AS DOUBLE) AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS airport_fee,
    l_partkey AS part_key,
    CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(month(l_shipdate) AS INTEGER) AS month
  FROM lineitem
),
trips AS (SELECT * EXCLUDE (part_key) FROM raw)
"""

_SILVER = """
silver AS (
  SELECT * EXCLUDE (year, month),
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
  FROM trips WHERE trip_distance > 0 AND fare_amount >= 0
)
"""


def _money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE)"


def _mean(column: str) -> str:
    return f"{_money(column)} / count({column})"


def _kpis(source: str, by: str) -> str:
    return f"""
  SELECT {by}, count(*) AS trips,
    {_money('fare_amount')} AS total_fare,
    {_money('tip_amount')} AS total_tip,
    CAST(round(CAST({_mean('trip_distance')} AS DECIMAL(30, 12)), 2) AS DOUBLE) AS avg_distance
  FROM {source} GROUP BY {by}
"""


_GOLD = f"gold AS ({_kpis('silver', 'year, month')})"

_LAYERS = f"WITH {_RAW}, {_SILVER}, {_GOLD}"

_PAYLOAD = """
  tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
  fare_amount, tip_amount, PULocationID, DOLocationID, payment_type
"""

_PICKUP_MONTH = """
  CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
  CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
"""

_NOT_SENT = """
  CAST(NULL AS DOUBLE) AS VendorID, CAST(NULL AS DOUBLE) AS RatecodeID,
  CAST(NULL AS VARCHAR) AS store_and_fwd_flag, CAST(NULL AS DOUBLE) AS extra,
  CAST(NULL AS DOUBLE) AS mta_tax, CAST(NULL AS DOUBLE) AS tolls_amount,
  CAST(NULL AS DOUBLE) AS improvement_surcharge, CAST(NULL AS DOUBLE) AS total_amount,
  CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee
"""

_RUN = "'run-0001' AS run_id, CAST(1700000000 AS BIGINT) AS run_epoch"


def _scorecard(source: str, rules: list[tuple[str, str, str, float]]) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {where}) AS {count}" for count, _, where, _ in rules)
    rates = ", ".join(
        f"CASE WHEN rows_total > 0 THEN CAST({count} AS DOUBLE) / rows_total ELSE 1.0 END AS {rate}"
        for count, rate, _, _ in rules
    )
    gate = " AND ".join(f"{rate} <= {limit}" for _, rate, _, limit in rules)
    return f"""
, counted AS (SELECT count(*) AS rows_total, {counts} FROM {source}),
rated AS (SELECT *, {rates} FROM counted)
SELECT {_RUN}, *, CAST({gate} AS INTEGER) AS passed FROM rated
"""


_TRIP_RULES = [
    ("null_trip_distance", "rate_null_distance", "trip_distance IS NULL", 0.05),
    ("null_fare_amount", "rate_null_fare", "fare_amount IS NULL", 0.05),
    ("bad_distance", "rate_bad_distance", "trip_distance <= 0", 0.02),
    ("bad_fare", "rate_bad_fare", "fare_amount < 0", 0.02),
]

_BALANCE_RULES = [
    ("null_balance", "rate_null_balance", "c_acctbal IS NULL", 0.05),
    ("bad_balance", "rate_bad_balance", "c_acctbal < 0", 0.02),
]

_RUNS = """
WITH runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id,
    CAST(floor(epoch(ts)) AS BIGINT) AS run_epoch,
    user_id AS rows_total, value AS trips_total,
    CAST(event_type <> 'error' AS INTEGER) AS passed
  FROM events
)
"""

_COLOR = "CASE o_orderstatus WHEN 'O' THEN 'yellow' WHEN 'F' THEN 'green' ELSE 'fhv' END"

_METRICS = f"""
SELECT {_RUN},
  (SELECT count(*) FROM (SELECT DISTINCT year, month FROM gold)) AS months_covered,
  count(*) AS rows_gold,
  CAST(sum(trips) AS DOUBLE) AS trips_total,
  {_money('total_fare')} AS fare_total,
  {_money('total_tip')} AS tip_total,
  {_mean('avg_distance')} AS avg_distance_over_months
FROM gold
"""


def _records(scored: str) -> str:
    """The scorecard of one layer and the metrics of Gold, all columns of both."""
    return f"""
SELECT 'dq_results' AS record, * FROM (WITH {_RAW}, {_SILVER} {_scorecard(scored, _TRIP_RULES)})
UNION ALL BY NAME
SELECT 'metrics_pipeline_runs' AS record, * FROM ({_LAYERS} {_METRICS})
"""


ORACLE_SQL: dict[str, str] = {
    "gold_monthly_kpis": f"{_LAYERS} SELECT * FROM gold",
    "bronze_ingest": f"WITH {_RAW} SELECT * FROM trips",
    "bronze_ingest_month": f"""
WITH {_RAW} SELECT * REPLACE (1995 AS year, 1 AS month) FROM trips
""",
    "bronze_ingest_mixed": f"""
WITH {_RAW}
SELECT * REPLACE (2001 AS year, 1 AS month) FROM trips WHERE year <= 1996
UNION ALL BY NAME
SELECT {_PAYLOAD}, {_NOT_SENT}, 2001 AS year, 2 AS month FROM trips WHERE year > 1996
""",
    "bronze_int96": f"""
WITH {_RAW} SELECT * REPLACE (
  CAST(CASE WHEN year <= 1995 THEN 1992 ELSE 1996 END AS INTEGER) AS year, 2 AS month
) FROM trips
""",
    "bronze_skip_corrupt": f"WITH {_RAW}, {_SILVER} SELECT *, 2 AS left_out FROM silver",
    "bronze_conform": f"""
WITH {_RAW}
SELECT * FROM trips WHERE year < 2000
UNION ALL BY NAME
SELECT {_PAYLOAD}, {_NOT_SENT}, year, month FROM trips WHERE year >= 2000
""",
    "bronze_dynamic_overwrite": f"""
WITH {_RAW}
SELECT year, month, count(*) AS row_count,
  {_money('CASE WHEN year = 1998 THEN fare_amount * 2 ELSE fare_amount END')} AS fare
FROM trips GROUP BY year, month
""",
    "month_from_filename": rf"""
WITH names AS (
  SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {_COLOR} || '_tripdata.parquet'
    ELSE {_COLOR} || '_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet' END AS name
  FROM orders
)
SELECT name, count(*) AS n,
  TRY_CAST(regexp_extract(name, '(\d{{4}})-(\d{{2}})', 1) AS INTEGER) AS year,
  TRY_CAST(regexp_extract(name, '(\d{{4}})-(\d{{2}})', 2) AS INTEGER) AS month
FROM names GROUP BY name
""",
    "silver_clean": f"WITH {_RAW}, {_SILVER} SELECT * FROM silver",
    "silver_write": f"WITH {_RAW}, {_SILVER} SELECT * FROM silver",
    "silver_incremental": f"""
WITH {_RAW.replace('FROM lineitem', 'FROM lineitem WHERE NOT (year(l_shipdate) = 1995 AND month(l_shipdate) = 3 AND l_linenumber <= 2)')}, {_SILVER}
SELECT * FROM silver
""",
    "batch_resume": f"""
WITH {_RAW.replace('FROM lineitem', '''FROM lineitem
  WHERE CASE WHEN year(l_shipdate) = 1995 AND month(l_shipdate) = 3 THEN l_linenumber > 2
    ELSE l_linenumber > 1 END''')}, {_SILVER}
SELECT * FROM silver
""",
    "silver_compact": f"WITH {_RAW}, {_SILVER} SELECT *, 0 AS left FROM silver",
    "gold_from_states": f"{_LAYERS} SELECT * FROM gold",
    "gold_publish": f"{_LAYERS} SELECT * FROM gold",
    "dq_profile": f"WITH {_RAW} {_scorecard('trips', _TRIP_RULES)}",
    "dq_score_silver": f"WITH {_RAW}, {_SILVER} {_scorecard('silver', _TRIP_RULES)}",
    "dq_score_bronze": f"WITH {_RAW} {_scorecard('trips', _TRIP_RULES)}",
    "dq_observed_bronze": f"WITH {_RAW} {_scorecard('trips', _TRIP_RULES)}",
    "dq_observed_silver": f"WITH {_RAW}, {_SILVER} {_scorecard('silver', _TRIP_RULES)}",
    "dq_record_once": f"WITH {_RAW} {_scorecard('trips', _TRIP_RULES)}",
    "dq_account_balance": f"""
WITH accounts AS (SELECT * FROM customer) {_scorecard('accounts', _BALANCE_RULES)}
""",
    "dq_failed_runs": f"{_RUNS} SELECT * FROM runs WHERE passed = 0",
    "eval_gold": f"{_LAYERS} {_METRICS}",
    "eval_gold_empty": f"""
WITH {_RAW.replace('trips AS (SELECT * EXCLUDE (part_key) FROM raw)', '''trips AS (
  SELECT * FROM raw WHERE NOT coalesce(trip_distance > 0 AND fare_amount >= 0, false)
)''')}, {_SILVER}, {_GOLD}
SELECT {_RUN},
  (SELECT count(*) FROM (SELECT DISTINCT year, month FROM gold)) AS months_covered,
  count(*) AS rows_gold,
  coalesce(CAST(sum(trips) AS DOUBLE), 0.0) AS trips_total,
  coalesce({_money('total_fare')}, 0.0) AS fare_total,
  coalesce({_money('total_tip')}, 0.0) AS tip_total,
  coalesce(avg(avg_distance), 0.0) AS avg_distance_over_months
FROM gold
""",
    "zone_lookup_load": """
SELECT CAST(c_custkey AS INTEGER) AS location_id, n_name AS borough,
  c_name AS zone, c_mktsegment AS service_zone
FROM customer JOIN nation ON c_nationkey = n_nationkey
""",
    "kafka_encode": f"WITH {_RAW} SELECT {_PAYLOAD}, {_PICKUP_MONTH} FROM trips",
    "kafka_decode": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""",
    "topic_publish": f"WITH {_RAW} SELECT {_PAYLOAD}, {_PICKUP_MONTH} FROM trips",
    "topic_replay": f"{_LAYERS} SELECT * FROM gold",
    "topic_follow": f"{_LAYERS} SELECT * FROM gold",
    "topic_to_bronze": f"WITH {_RAW} SELECT {_PAYLOAD}, {_NOT_SENT}, {_PICKUP_MONTH} FROM trips",
    "topic_peek": """
SELECT 'events' AS topic, CAST(event_id % 3 AS INTEGER) AS partition,
  event_id AS "offset", props AS value
FROM events ORDER BY partition, "offset" LIMIT 10
""",
    "latest_dq": f"""
{_RUNS} SELECT run_id, run_epoch, rows_total, passed FROM runs
ORDER BY run_epoch DESC, run_id DESC LIMIT 1
""",
    "latest_metrics": f"""
{_RUNS} SELECT run_id, run_epoch, trips_total FROM runs
ORDER BY run_epoch DESC, run_id DESC LIMIT 1
""",
    "recent_runs": f"{_RUNS} SELECT * FROM runs ORDER BY run_epoch DESC, run_id DESC LIMIT 5",
    "serve_recent_months": f"""
{_LAYERS} SELECT * FROM gold WHERE year IS NOT NULL ORDER BY year DESC, month DESC LIMIT 10
""",
    "serve_year": f"{_LAYERS} SELECT * FROM gold WHERE year = 1998",
    "serve_counts": f"""
{_LAYERS}
SELECT 'bronze' AS layer, count(*) AS row_count FROM trips
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(*) FROM gold
""",
    "serve_sql_views": f"SELECT * EXCLUDE (record) FROM ({_records('trips')})",
    "validate_null_kpis": f"""
{_LAYERS}
SELECT count(*) FILTER (WHERE year IS NULL) AS null_years,
  count(*) FILTER (WHERE month IS NULL) AS null_months,
  count(*) FILTER (WHERE trips IS NULL) AS null_trips
FROM gold
""",
    "validate_negative_kpis": f"""
WITH {_RAW}, kpis AS ({_kpis('raw', 'part_key')})
SELECT * FROM kpis WHERE total_fare < 0 OR total_tip < 0
""",
    "validate_outlier_months": f"""
{_LAYERS} SELECT year, month, trips FROM gold
WHERE trips > (SELECT avg(trips) * 1.05 FROM gold)
""",
    "validate_reconciliation": f"""
{_LAYERS}, counted AS (
  SELECT (SELECT count(*) FROM trips) AS bronze_rows,
    (SELECT count(*) FROM silver) AS silver_rows,
    CAST((SELECT coalesce(sum(trips), 0) FROM gold) AS BIGINT) AS gold_trips
)
SELECT *, bronze_rows - silver_rows AS rejected_rows, silver_rows = gold_trips AS ok FROM counted
""",
    "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "chain_batch": f"{_LAYERS} SELECT * FROM gold",
    "chain_topic": f"{_LAYERS} SELECT * FROM gold",
    "chain_evaluation": _records("silver"),
}
