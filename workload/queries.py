"""One query per operator. Queries that write do so below the shared scratch folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions import exact_sum, month_columns, month_path
from farelake.operators import (
    Rule,
    clean_trips,
    failed_runs,
    latest_run,
    monthly_kpis,
    months_of_year,
    negative_kpis,
    null_kpis,
    outlier_months,
    pk_violations,
    profile,
    recent_months,
    recent_runs,
    reconcile,
    row_counts,
    summarise_gold,
)
from farelake.plans import (
    build_gold,
    build_silver,
    compact_silver,
    evaluate_gold,
    follow_topic,
    ingest_bronze,
    ingest_bronze_counted,
    ingest_bronze_months,
    ingest_topic,
    load_zone_lookup,
    publish_topic,
    record_counts,
    run_batch,
    run_batch_all,
    run_evaluation,
    run_states,
    run_topic_batch,
    score_bronze,
    score_silver,
    small_months,
    start_batch,
)
from farelake.schemas import PAYLOAD, TOPIC_DATASET, contract
from farelake.session import scratch_path
from farelake.sinks import FileWarehouse, append_months, register_views, write_months
from farelake.sources import read_bronze, read_gold_or_empty, read_silver
from farelake.streaming import FileTopic, decode, decode_trips, encode, peek
from workload.tables import (
    RUN_EPOCH,
    RUN_ID,
    envelope,
    event_messages,
    event_runs,
    gold,
    raw_trips,
    silver,
    table,
    trips,
    write_bronze,
    write_one_raw,
    write_raw,
)

DATASET = "yellow_tripdata"
#: Trips without a pickup are published under this month and shown as null again.
UNDATED = (1900, 1)


def published(spark: SparkSession, warehouse: FileWarehouse) -> DataFrame:
    """The monthly fact table, the stand-in for the null month as null."""
    stored = warehouse.read(spark, "fact_trips_monthly")
    dated = F.col("year") != UNDATED[0]
    return stored.withColumn("month", F.when(dated, F.col("month"))).withColumn(
        "year", F.when(dated, F.col("year"))
    )


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "bronze-ingest")
    write_raw(spark, sf_dir, f"{base}/raw")
    ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")
    return read_bronze(spark, f"{base}/bronze")


def bronze_ingest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "bronze-ingest-month")
    path = f"{base}/raw/{DATASET}_1995-01.parquet"
    write_one_raw(spark, sf_dir, path)
    ingest_bronze(spark, path, f"{base}/bronze")
    return read_bronze(spark, f"{base}/bronze")


def bronze_int96(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months named by the rule for raw files, with timestamps in the old 96-bit form."""
    base = scratch_path(spark, "bronze-int96")
    raw = raw_trips(table(spark, sf_dir, "lineitem"))
    old = spark.newSession()
    old.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    for year, where in ((1992, "file_year <= 1995"), (1996, "file_year > 1995")):
        path = month_path(f"{base}/raw", "yellow", year, 2)
        raw.where(where).drop("part_key", "file_year", "file_month").write.parquet(f"{path}-new")
        old.read.parquet(f"{path}-new").write.parquet(path)
        ingest_bronze(spark, path, f"{base}/bronze")
    return read_bronze(spark, f"{base}/bronze")


def bronze_skip_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and the count of files left out, where two months hold files that are no Parquet."""
    base = scratch_path(spark, "bronze-corrupt")
    write_bronze(spark, sf_dir, f"{base}/bronze")
    broken = table(spark, sf_dir, "nation").select("n_name").coalesce(1)
    for month in (3, 4):
        leaf = f"{base}/bronze/{DATASET}/year=1995/month={month}"
        broken.write.mode("append").text(leaf)
    built = build_silver(spark, f"{base}/bronze", f"{base}/silver", skip_corrupt=True)
    silver = read_silver(spark, f"{base}/silver")
    return silver.withColumn("left_out", F.lit(len(built.skipped)))


def bronze_ingest_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw month of files with three types of a column, and one without some columns."""
    base = scratch_path(spark, "bronze-ingest-mixed")
    raw = raw_trips(table(spark, sf_dir, "lineitem")).drop("part_key", "file_month")
    vendor, year = F.col("VendorID"), F.col("file_year")
    for kind, rows in (
        ("int", raw.where(year <= 1993)),
        ("bigint", raw.where(year == 1994)),
        ("double", raw.where(year.between(1995, 1996))),
    ):
        rows = rows.withColumn("VendorID", vendor.cast(kind)).drop("file_year")
        rows.write.mode("append").parquet(f"{base}/raw/{DATASET}_2001-01.parquet")
    late = raw.where(year > 1996).select(*PAYLOAD.names)
    late.write.parquet(f"{base}/raw/{DATASET}_2001-02.parquet")
    ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")
    return read_bronze(spark, f"{base}/bronze")


def bronze_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "bronze-conform")
    rows = trips(spark, sf_dir)
    year = F.col("year")
    vintages = [
        rows.where(year <= 1996).withColumn("VendorID", F.col("VendorID").cast("int")),
        rows.where(year.between(1997, 1998)).withColumn("VendorID", F.col("VendorID").cast("bigint")),
        rows.where(year == 1999).withColumnRenamed("airport_fee", "Airport_fee"),
        rows.where(year >= 2000).select(*PAYLOAD.names, "year", "month"),
    ]
    for vintage in vintages:
        by_month = vintage.hint("rebalance", "year", "month")
        write_months(by_month, f"{base}/{DATASET}", replace="present")
    return read_bronze(spark, base)


def bronze_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "bronze-overwrite")
    write_bronze(spark, sf_dir, base)
    late = trips(spark, sf_dir).where("year = 1998").withColumn("fare_amount", F.col("fare_amount") * 2)
    write_months(late.hint("rebalance", "year", "month"), f"{base}/{DATASET}", replace="present")
    return (
        read_bronze(spark, base)
        .groupBy("year", "month")
        .agg(F.count("*").alias("row_count"), F.round(exact_sum("fare_amount"), 2).alias("fare"))
    )


def month_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    color = F.when(status == "O", "yellow").when(status == "F", "green").otherwise("fhv")
    dated = F.concat(color, F.lit("_tripdata_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".parquet"))
    undated = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    names = table(spark, sf_dir, "orders").select(
        F.when(undated, F.concat(color, F.lit("_tripdata.parquet"))).otherwise(dated).alias("name")
    )
    return names.groupBy("name").agg(F.count("*").alias("n")).withColumns(month_columns(F.col("name")))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir)


def silver_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "silver-write")
    write_bronze(spark, sf_dir, f"{base}/bronze")
    build_silver(spark, f"{base}/bronze", f"{base}/silver")
    return read_silver(spark, f"{base}/silver")


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after two runs of one month: the second file has only some of its trips."""
    base = scratch_path(spark, "silver-incremental")
    write_raw(spark, sf_dir, f"{base}/raw")
    warehouse = FileWarehouse(f"{base}/warehouse")
    layers = f"{base}/bronze", f"{base}/silver", f"{base}/gold", warehouse
    run_batch_all(spark, f"{base}/raw", *layers, undated=UNDATED)
    path = f"{base}/again/{DATASET}_1995-03.parquet"
    whole = raw_trips(table(spark, sf_dir, "lineitem"))
    month = whole.where("file_year = 1995 AND file_month = 3 AND payment_type > 2")
    month.drop("part_key", "file_year", "file_month").write.parquet(path)
    run_batch(spark, path, *layers, undated=UNDATED)
    return read_silver(spark, f"{base}/silver")


def batch_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a run that ended when its Bronze month was written, and the next run of it.

    The month's first file holds the strays of all others too; the second has some of
    its own trips only.
    """
    base = scratch_path(spark, "batch-resume")
    raw = raw_trips(table(spark, sf_dir, "lineitem"))
    here = "file_year = 1995 AND file_month = 3"
    stray = raw.where(f"NOT ({here}) AND payment_type = 1")
    month = raw.where(here).unionByName(stray).drop("part_key", "file_year", "file_month")
    rest = raw.where(f"NOT ({here}) AND payment_type > 1")
    rest = rest.drop("part_key", "file_year", "file_month")
    rest.write.parquet(f"{base}/raw/{DATASET}_2001-01.parquet")
    month.write.parquet(f"{base}/raw/{DATASET}_1995-03.parquet")
    warehouse = FileWarehouse(f"{base}/warehouse")
    layers = f"{base}/bronze", f"{base}/silver", f"{base}/gold"
    run_batch_all(spark, f"{base}/raw", *layers, warehouse, undated=UNDATED)
    path = f"{base}/again/{DATASET}_1995-03.parquet"
    fewer = raw.where(f"{here} AND payment_type > 2").drop("part_key", "file_year", "file_month")
    fewer.write.parquet(path)
    start_batch(spark, path, *layers)
    run_batch(spark, path, *layers, warehouse, undated=UNDATED)
    return read_silver(spark, f"{base}/silver")


def gold_monthly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(spark, sf_dir)


def gold_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "gold-publish")
    by_month = silver(spark, sf_dir).hint("rebalance", "year", "month")
    write_months(by_month, f"{base}/silver/{DATASET}", replace="all")
    warehouse = FileWarehouse(f"{base}/warehouse")
    build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse, undated=UNDATED)
    return published(spark, warehouse)


def gold_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from states of three raw months, the last of them read again with fewer trips."""
    base = scratch_path(spark, "gold-states")
    raw = raw_trips(table(spark, sf_dir, "lineitem"))
    warehouse = FileWarehouse(f"{base}/warehouse")
    layers = f"{base}/bronze", f"{base}/gold", warehouse
    for part, where in (
        ("1995-01", "payment_type = 1"),
        ("1995-02", "payment_type IN (2, 3)"),
        ("1995-03", "payment_type > 3 OR payment_type = 1"),
        ("1995-03", "payment_type > 3"),
    ):
        path = f"{base}/raw/{DATASET}_{part}.parquet"
        rows = raw.where(where).drop("part_key", "file_year", "file_month")
        rows.write.mode("overwrite").parquet(path)
        run_states(spark, path, *layers, undated=UNDATED)
    return published(spark, warehouse)


def silver_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after its small files were packed, with the number of months that still have some."""
    base = scratch_path(spark, "silver-compact")
    path = f"{base}/silver/{DATASET}"
    rows = silver(spark, sf_dir).where("VendorID = 1")
    kept = silver(spark, sf_dir).where("VendorID <> 1")
    write_months(kept.hint("rebalance", "year", "month"), path, replace="all")
    parts = rows.withColumn("part", F.pmod(F.xxhash64("PULocationID", "DOLocationID"), F.lit(3)))
    append_months(parts.hint("rebalance", "year", "month", "part").drop("part"), path)
    compact_silver(spark, f"{base}/silver")
    left = len(small_months(spark, f"{base}/silver"))
    return read_silver(spark, f"{base}/silver").withColumn("left", F.lit(left))


def chain_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "chain-batch")
    write_raw(spark, sf_dir, f"{base}/raw")
    warehouse = FileWarehouse(f"{base}/warehouse")
    layers = f"{base}/bronze", f"{base}/silver", f"{base}/gold", warehouse
    run_batch_all(spark, f"{base}/raw", *layers, undated=UNDATED)
    return published(spark, warehouse)


def chain_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "chain-topic")
    path = f"{base}/raw/{DATASET}_1995-01.parquet"
    write_one_raw(spark, sf_dir, path)
    warehouse = FileWarehouse(f"{base}/warehouse")
    layers = f"{base}/bronze", f"{base}/silver", f"{base}/gold", warehouse
    run_topic_batch(spark, path, FileTopic(f"{base}/topic"), *layers, undated=UNDATED)
    return published(spark, warehouse)


def chain_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "chain-evaluation")
    by_month = silver(spark, sf_dir).hint("rebalance", "year", "month")
    write_months(by_month, f"{base}/silver/{DATASET}", replace="all")
    warehouse = FileWarehouse(f"{base}/warehouse")
    build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse, undated=UNDATED)
    run = (RUN_ID, RUN_EPOCH)
    run_evaluation(spark, f"{base}/silver", f"{base}/gold", warehouse, runs=(run, run))
    records = [
        warehouse.read(spark, name).withColumn("record", F.lit(name))
        for name in ("dq_results", "metrics_pipeline_runs")
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(trips(spark, sf_dir), RUN_ID, RUN_EPOCH)


def dq_score_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "dq-score")
    by_month = silver(spark, sf_dir).hint("rebalance", "year", "month")
    write_months(by_month, f"{base}/silver/{DATASET}", replace="all")
    warehouse = FileWarehouse(f"{base}/warehouse")
    score_silver(spark, f"{base}/silver", warehouse, run=(RUN_ID, RUN_EPOCH))
    return warehouse.read(spark, "dq_results")


def dq_score_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "dq-score-bronze")
    write_bronze(spark, sf_dir, f"{base}/bronze")
    warehouse = FileWarehouse(f"{base}/warehouse")
    score_bronze(spark, f"{base}/bronze", warehouse, run=(RUN_ID, RUN_EPOCH))
    return warehouse.read(spark, "dq_results")


def dq_observed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard of a Bronze month, counted by the tasks that wrote it."""
    base = scratch_path(spark, "dq-observed-bronze")
    path = f"{base}/raw/{DATASET}_1995-01.parquet"
    write_one_raw(spark, sf_dir, path)
    warehouse = FileWarehouse(f"{base}/warehouse")
    counted = ingest_bronze_counted(spark, path, f"{base}/bronze")
    record_counts(spark, counted, warehouse, run=(RUN_ID, RUN_EPOCH))
    return warehouse.read(spark, "dq_results")


def dq_observed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard of Silver, counted by the tasks that wrote it."""
    base = scratch_path(spark, "dq-observed-silver")
    write_bronze(spark, sf_dir, f"{base}/bronze")
    warehouse = FileWarehouse(f"{base}/warehouse")
    built = build_silver(spark, f"{base}/bronze", f"{base}/silver")
    record_counts(spark, built.counted, warehouse, run=(RUN_ID, RUN_EPOCH))
    return warehouse.read(spark, "dq_results")


def dq_record_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation of one run, tried again."""
    base = scratch_path(spark, "dq-once")
    write_bronze(spark, sf_dir, f"{base}/bronze")
    warehouse = FileWarehouse(f"{base}/warehouse")
    for _ in range(2):
        score_bronze(spark, f"{base}/bronze", warehouse, run=(RUN_ID, RUN_EPOCH))
    return warehouse.read(spark, "dq_results")


def dq_account_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    rules = [
        Rule("null_balance", "rate_null_balance", balance.isNull(), 0.05),
        Rule("bad_balance", "rate_bad_balance", balance < 0, 0.02),
    ]
    return profile(table(spark, sf_dir, "customer"), RUN_ID, RUN_EPOCH, rules)


def eval_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise_gold(gold(spark, sf_dir), RUN_ID, RUN_EPOCH)


def eval_gold_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "eval-empty")
    kept = (F.col("trip_distance") > 0) & (F.col("fare_amount") >= 0)
    rejected = trips(spark, sf_dir).where(~F.coalesce(kept, F.lit(False)))
    write_months(clean_trips(rejected), f"{base}/silver/{DATASET}", replace="all")
    warehouse = FileWarehouse(f"{base}/warehouse")
    build_gold(spark, f"{base}/silver", f"{base}/gold", warehouse, undated=UNDATED)
    evaluate_gold(spark, f"{base}/gold", warehouse, run=(RUN_ID, RUN_EPOCH))
    return warehouse.read(spark, "metrics_pipeline_runs")


def zone_lookup_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "zones")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    zones = table(spark, sf_dir, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("LocationID"),
        F.col("n_name").alias("Borough"),
        F.col("c_name").alias("Zone"),
        F.col("c_mktsegment").alias("service_zone"),
    )
    zones.write.option("header", True).csv(f"{base}/csv")
    warehouse = FileWarehouse(f"{base}/warehouse")
    load_zone_lookup(spark, f"{base}/csv", warehouse)
    return warehouse.read(spark, "taxi_zone_lookup")


def kafka_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_trips(envelope(encode(trips(spark, sf_dir).drop("year", "month"))))


def kafka_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(event_messages(spark, sf_dir), contract("k int"), keep=["event_id"])


def topic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "topic-publish")
    path = f"{base}/raw/{DATASET}_1995-01.parquet"
    write_one_raw(spark, sf_dir, path)
    topic = FileTopic(f"{base}/topic")
    publish_topic(spark, path, topic)
    return decode_trips(topic.read(spark))


def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic chain run twice on one input: the second time every message is a repeated one."""
    base = scratch_path(spark, "topic-replay")
    path = f"{base}/raw/{DATASET}_1995-01.parquet"
    write_one_raw(spark, sf_dir, path)
    warehouse = FileWarehouse(f"{base}/warehouse")
    layers = f"{base}/bronze", f"{base}/silver", f"{base}/gold", warehouse
    topic = FileTopic(f"{base}/topic")
    for _ in range(2):
        run_topic_batch(spark, path, topic, *layers, undated=UNDATED)
    return published(spark, warehouse)


def topic_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic that is followed: some messages, then the rest and some of the first again."""
    base = scratch_path(spark, "topic-follow")
    raw = raw_trips(table(spark, sf_dir, "lineitem")).drop("part_key", "file_year", "file_month")
    topic = FileTopic(f"{base}/topic")
    warehouse = FileWarehouse(f"{base}/warehouse")
    layers = f"{base}/bronze", f"{base}/silver", f"{base}/gold", warehouse
    first, second = (f"{base}/raw/{DATASET}_1995-0{month}.parquet" for month in (1, 2))
    raw.where("payment_type <= 3").write.parquet(first)
    raw.where("payment_type > 3").write.parquet(second)
    for again in ([first], [second, first]):
        for path in again:
            publish_topic(spark, path, topic)
        follow_topic(spark, topic, *layers, f"{base}/checkpoint", undated=UNDATED)
    return published(spark, warehouse)


def topic_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "topic-bronze")
    topic = FileTopic(f"{base}/topic")
    topic.write(encode(trips(spark, sf_dir).drop("year", "month")))
    ingest_topic(spark, topic, base)
    return read_bronze(spark, base, TOPIC_DATASET)


def topic_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = peek(event_messages(spark, sf_dir), 10)
    return first.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def latest_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_run(event_runs(spark, sf_dir).drop("trips_total"))


def latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_run(event_runs(spark, sf_dir).drop("passed", "rows_total"))


def recent_runs_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_runs(event_runs(spark, sf_dir), 5)


def dq_failed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_runs(event_runs(spark, sf_dir))


def serve_recent_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_months(gold(spark, sf_dir).where("year IS NOT NULL"), 10)


def serve_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "serve-year")
    write_months(gold(spark, sf_dir), f"{base}/kpis_trips_monthly", replace="all")
    return months_of_year(read_gold_or_empty(spark, base), 1998)


def serve_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(
        {
            "bronze": trips(spark, sf_dir),
            "silver": silver(spark, sf_dir),
            "gold": gold(spark, sf_dir),
        }
    )


def serve_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "serve-views")
    warehouse = FileWarehouse(f"{base}/warehouse")
    scored = profile(trips(spark, sf_dir), RUN_ID, RUN_EPOCH)
    warehouse.append(scored, "dq_results")
    warehouse.append(summarise_gold(gold(spark, sf_dir), RUN_ID, RUN_EPOCH), "metrics_pipeline_runs")
    register_views(spark, warehouse, ["dq_results", "metrics_pipeline_runs"])
    latest = [spark.sql(f"SELECT * FROM {v}") for v in ("v_latest_dq", "v_latest_metrics")]
    return latest[0].unionByName(latest[1], allowMissingColumns=True)


def validate_null_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_kpis(gold(spark, sf_dir))


def validate_negative_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(table(spark, sf_dir, "lineitem"))
    return negative_kpis(monthly_kpis(raw, by=["part_key"]))


def validate_outlier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outlier_months(gold(spark, sf_dir), 1.05).select("year", "month", "trips")


def validate_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile(trips(spark, sf_dir), silver(spark, sf_dir), gold(spark, sf_dir))


def pk_violations_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_monthly_kpis": gold_monthly_kpis,
    "bronze_ingest": bronze_ingest,
    "bronze_ingest_month": bronze_ingest_month,
    "bronze_ingest_mixed": bronze_ingest_mixed,
    "bronze_int96": bronze_int96,
    "bronze_skip_corrupt": bronze_skip_corrupt,
    "bronze_conform": bronze_conform,
    "bronze_dynamic_overwrite": bronze_dynamic_overwrite,
    "month_from_filename": month_from_filename,
    "silver_clean": silver_clean,
    "silver_write": silver_write,
    "silver_incremental": silver_incremental,
    "batch_resume": batch_resume,
    "silver_compact": silver_compact,
    "gold_publish": gold_publish,
    "gold_from_states": gold_from_states,
    "dq_profile": dq_profile,
    "dq_score_silver": dq_score_silver,
    "dq_score_bronze": dq_score_bronze,
    "dq_record_once": dq_record_once,
    "dq_observed_bronze": dq_observed_bronze,
    "dq_observed_silver": dq_observed_silver,
    "dq_account_balance": dq_account_balance,
    "dq_failed_runs": dq_failed_runs,
    "eval_gold": eval_gold,
    "eval_gold_empty": eval_gold_empty,
    "zone_lookup_load": zone_lookup_load,
    "kafka_encode": kafka_encode,
    "kafka_decode": kafka_decode,
    "topic_publish": topic_publish,
    "topic_replay": topic_replay,
    "topic_follow": topic_follow,
    "topic_to_bronze": topic_to_bronze,
    "topic_peek": topic_peek,
    "latest_dq": latest_dq,
    "latest_metrics": latest_metrics,
    "recent_runs": recent_runs_5,
    "serve_recent_months": serve_recent_months,
    "serve_year": serve_year,
    "serve_counts": serve_counts,
    "serve_sql_views": serve_sql_views,
    "validate_null_kpis": validate_null_kpis,
    "validate_negative_kpis": validate_negative_kpis,
    "validate_outlier_months": validate_outlier_months,
    "validate_reconciliation": validate_reconciliation,
    "pk_violations": pk_violations_lineitem,
    "chain_batch": chain_batch,
    "chain_topic": chain_topic,
    "chain_evaluation": chain_evaluation,
}
