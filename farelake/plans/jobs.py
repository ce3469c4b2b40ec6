"""One function per job. Jobs hand over to each other through files alone."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from enum import Enum
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelake.functions.months import month_of_name
from farelake.operators import (
    Rule,
    clean_trips,
    counts,
    default_rules,
    fitted,
    monthly_kpis,
    profile,
    scored,
    summarise_gold,
)
from farelake.operators.clean import PICKUP
from farelake.plans.ledger import Ledger, Month
from farelake.schemas import (
    BRONZE,
    DEFAULT_DATASET,
    FACT_TRIPS_MONTHLY,
    GOLD_TABLE,
    TOPIC_DATASET,
)
from farelake.sinks import (
    Warehouse,
    cleared,
    exists,
    spread_by_month,
    staged,
    write_month,
    write_months,
)
from farelake.sources import (
    first_rows,
    raw_inputs,
    read_bronze,
    read_gold,
    read_gold_or_empty,
    read_inputs,
    read_raw,
    read_silver,
    read_zone_csv,
    scanned_path,
    skipped_files,
)
from farelake.streaming import Topic, encode, last_of_each_key, message_key, trip_messages


_MONTHS_AT_ONCE = 8
_LOG = logging.getLogger(__name__)


class GoldStatus(Enum):
    """What became of a Gold build."""

    WRITTEN = "written"
    SILVER_EMPTY = "silver is empty, gold was left as it is"


def new_run() -> tuple[str, int]:
    """An id and the time in whole seconds for one run record."""
    return str(uuid.uuid4()), int(time.time())


def ingest_bronze(
    spark: SparkSession,
    input_path: str,
    bronze_base: str,
    dataset: str = DEFAULT_DATASET,
    skip_corrupt: bool = False,
) -> str:
    """One raw month into Bronze; its month is read from the name of the input.

    Columns and types stay as they are in the file; where files of the month differ
    in the type of a column, it gets the widest. Returns the path written.
    """
    rows = read_inputs(spark, [input_path], skip_corrupt)[input_path]
    return write_month(rows, f"{bronze_base}/{dataset}", *month_of_name(input_path))


def ingest_bronze_counted(
    spark: SparkSession,
    input_path: str,
    bronze_base: str,
    dataset: str = DEFAULT_DATASET,
    skip_corrupt: bool = False,
) -> dict[str, int]:
    """One raw month into Bronze as by :func:`ingest_bronze`; returns its scorecard's counts.

    They are taken while the rows are written, of the columns as the contract has them.
    """
    rows = read_inputs(spark, [input_path], skip_corrupt)[input_path]
    distance, fare = (fitted(rows, BRONZE[name]) for name in ("trip_distance", "fare_amount"))
    rows, seen = _observed(rows, default_rules(distance, fare))
    write_month(rows, f"{bronze_base}/{dataset}", *month_of_name(input_path))
    return seen.get


def ingest_bronze_months(
    spark: SparkSession,
    raw_base: str,
    bronze_base: str,
    dataset: str = DEFAULT_DATASET,
    skip_corrupt: bool = False,
) -> list[str]:
    """All raw months of a dataset into Bronze. Returns the inputs.

    The inputs' footers are merged in one look. Every month is then written on its
    own, several at a time, straight into its directory: tasks write where they
    read, nothing is shuffled or sorted, and no row is parsed for its month. Files of
    one month whose types differ are brought to the widest and written together. A
    month has the columns of all inputs of its schema; those it lacks are null.
    """
    inputs = raw_inputs(spark, raw_base, dataset)
    if not inputs:
        raise FileNotFoundError(f"no inputs of {dataset} in {raw_base}")
    named = {}
    for path in inputs:
        other = named.setdefault(month_of_name(path), path)
        if other != path:
            raise ValueError(f"{other} and {path} are the same month; Bronze keeps one input each")
    frames = read_inputs(spark, inputs, skip_corrupt)
    root = f"{bronze_base}/{dataset}"
    with ThreadPoolExecutor(_MONTHS_AT_ONCE) as pool:
        list(pool.map(lambda path: write_month(frames[path], root, *month_of_name(path)), inputs))
    return inputs


class SilverBuild(NamedTuple):
    """Where Silver was written, the Bronze files that were skipped as corrupt, and the
    counts of a scorecard, taken while its rows were written."""

    path: str
    skipped: list[str]
    counted: dict[str, int]


def _observed(rows: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """Rows whose scorecard is counted by whatever writes them."""
    seen = Observation()
    return rows.observe(seen, *counts(rules)), seen


def pickup_months(trips: DataFrame, pickup: str = PICKUP) -> set[Month]:
    """Months of the pickups of some trips; (None, None) for trips without one.

    Reads one column. Text that is no time counts as without one, as in Silver.
    """
    names = {name.lower(): name for name in trips.columns}
    if pickup.lower() not in names:
        return {(None, None)}
    day = F.col(names[pickup.lower()]).try_cast("timestamp").cast("date")
    months = trips.select(F.year(day).alias("year"), F.month(day).alias("month")).distinct()
    return {(row.year, row.month) for row in months.collect()}


def _picked_up_in(months: set[Month]) -> Column:
    """A filter on the pickup that reaches the scan; months that follow one another are one range."""
    found = F.col(PICKUP).isNull() if (None, None) in months else F.lit(False)
    ranges: list[list[int]] = []
    for number in sorted(12 * year + month - 1 for year, month in months if year is not None):
        if ranges and ranges[-1][1] == number:
            ranges[-1][1] = number + 1
        else:
            ranges.append([number, number + 1])
    for bounds in ranges:
        since, until = (
            F.expr(f"TIMESTAMP '{number // 12:04d}-{number % 12 + 1:02d}-01'") for number in bounds
        )
        found = found | ((F.col(PICKUP) >= since) & (F.col(PICKUP) < until))
    return found


def dated_in(months: set[Month]) -> Column:
    """A filter on the partition columns."""
    found = F.lit(False)
    for year, month in sorted(months, key=str):
        if year is None:
            found = found | F.col("year").isNull()
        else:
            found = found | ((F.col("year") == year) & (F.col("month") == month))
    return found


def replace_months(spark: SparkSession, rows: DataFrame, path: str, months: set[Month]) -> None:
    """Overwrite some months; those without rows any more are overwritten with none.

    Which have rows is seen while they are written.
    """
    seen = Observation()
    left = F.collect_set(F.struct("year", "month")).alias("left")
    write_months(rows.observe(seen, left), path, replace="present")
    fields = [field for field in rows.schema if field.name not in ("year", "month")]
    present = {(row.year, row.month) for row in seen.get.get("left") or []}
    for year, month in months - present:
        write_month(spark.createDataFrame([], StructType(fields)), path, year, month)


def build_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
    skip_corrupt: bool = False,
    months: set[Month] | None = None,
) -> SilverBuild:
    """Silver from Bronze: all of it, or some pickup ``months`` and nothing else.

    ``pickup`` names the column of the raw files that dates a trip; Silver keeps
    it under the name of its contract. With ``skip_corrupt``, broken files are left
    out and named in the result.

    Silver is laid out by pickup month and Bronze by file month, which agree for
    nearly all rows: those are written by the task that read them. Only rows
    that move to another month, or to none, are shuffled. For some months Bronze is
    read with their pickup ranges pushed into the scan, whatever month the files
    belong to.
    """
    path = f"{silver_base}/{dataset}"
    bronze = read_bronze(
        spark, bronze_base, dataset, rename={pickup: PICKUP}, skip_corrupt=skip_corrupt
    )
    if months is not None:
        bronze = bronze.where(_picked_up_in(months))
    cleaned = clean_trips(
        bronze.withColumnsRenamed({"year": "file_year", "month": "file_month"})
    )
    at_home = F.col("year").eqNullSafe(F.col("file_year")) & F.col("month").eqNullSafe(
        F.col("file_month")
    )
    rows = cleaned.where(at_home).unionByName(spread_by_month(cleaned.where(~at_home)))
    rows, seen = _observed(rows.drop("file_year", "file_month"), default_rules())
    if months is None:
        write_months(rows, path, replace="all")
    else:
        replace_months(spark, rows, path, months)
    skipped = skipped_files(spark, bronze_base, dataset).collect() if skip_corrupt else []
    for row in skipped:
        _LOG.warning("skipped as corrupt or empty: %s", row.path)
    return SilverBuild(path, sorted(row.path for row in skipped), seen.get)


def build_gold(
    spark: SparkSession,
    silver_base: str,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    undated: Month | None = None,
    months: set[Month] | None = None,
) -> GoldStatus:
    """Monthly KPIs from Silver into Gold and from there into the warehouse.

    All months are built, or some ``months`` from their Silver directories. The
    aggregate leaves each month in one task, so each month is one file. The
    warehouse is filled from the files just written: the aggregate runs once,
    and a lost executor cannot make it run again.

    Gold keeps the KPIs of trips without a pickup under a null month. The serving
    table's key allows none: they are published under the year and month that
    ``undated`` gives; without it they stop the job before the table is touched.
    """
    silver = read_silver(spark, silver_base, dataset)
    if silver.isEmpty():
        return GoldStatus.SILVER_EMPTY
    path = f"{gold_base}/{GOLD_TABLE}"
    if months is None:
        write_months(monthly_kpis(silver), path, replace="all")
    else:
        touched = silver.where(dated_in(months))
        replace_months(spark, monthly_kpis(touched), path, months)
    publish_gold(spark, gold_base, warehouse, undated)
    return GoldStatus.WRITTEN


def publish_gold(
    spark: SparkSession, gold_base: str, warehouse: Warehouse, undated: Month | None = None
) -> None:
    """Gold as the whole content of the serving table; the null month under ``undated``."""
    published = read_gold(spark, gold_base).select(*FACT_TRIPS_MONTHLY.names)
    if undated is not None:
        published = published.fillna(dict(zip(("year", "month"), undated)))
    warehouse.replace(published, "fact_trips_monthly")


def ingest_messages(
    envelope: DataFrame, bronze_base: str, dataset: str = DEFAULT_DATASET
) -> str:
    """Messages into Bronze by pickup month; months without messages are kept.

    Of messages with one key the last counts, so it doesn't matter how often a record was
    published. Bronze keeps what names and orders a message beside the record. The records
    are written before they are dealt out by month, so the disk never holds both exchanges.
    """
    path = f"{bronze_base}/{dataset}"
    with staged(trip_messages(envelope), "messages") as records:
        write_months(spread_by_month(records), path, replace="present")
    return path


def ingest_topic(
    spark: SparkSession, topic: Topic, bronze_base: str, dataset: str = TOPIC_DATASET
) -> str:
    """Everything a topic holds into Bronze.

    Whole months are overwritten, so a topic that is read in part is refused.
    """
    if not topic.whole:
        raise ValueError(
            "months would lose the messages that are not read; read the whole topic: all "
            "partitions from first to last offset, stopping where messages are lost"
        )
    return ingest_messages(topic.read(spark), bronze_base, dataset)


def _months_of(rows: DataFrame) -> set[Month]:
    with cleared(rows.sparkSession):
        return {(r.year, r.month) for r in rows.select("year", "month").distinct().collect()}


def _older_records(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Names and months of stored records whose keys come again.

    Keys begin alike, so their files are many times smaller than they are, and files are what
    Spark would choose a broadcast by.
    """
    digest = F.xxhash64("message_key").alias("digest")
    keys = fresh.select("message_key", digest).hint("merge")
    stored = stored.select("year", "month", "message_key", digest)
    return stored.join(keys, ["digest", "message_key"], "left_semi")


def merge_messages(
    spark: SparkSession, envelope: DataFrame, bronze_base: str, ledger: Ledger, dataset: str
) -> None:
    """More messages into Bronze, beside those it has.

    The months that are rewritten are those of the new records and those that hold
    older records of the same keys; these are written down in ``ledger`` first. Merging the same
    messages twice changes nothing.
    """
    with staged(trip_messages(envelope), "messages") as fresh:
        if not fresh.isEmpty():
            _merge_records(spark, fresh, f"{bronze_base}/{dataset}", ledger)


def _merge_records(spark: SparkSession, fresh: DataFrame, path: str, ledger: Ledger) -> None:
    months = _months_of(fresh)
    if not exists(spark, path):
        ledger.note(months)
        replace_months(spark, spread_by_month(fresh), path, months)
        return
    stored = spark.read.schema(fresh.schema).option("basePath", path).parquet(path)
    repeated = _months_of(_older_records(stored, fresh))
    months |= repeated
    ledger.note(months)
    both = stored.where(dated_in(months)).unionByName(fresh)
    if not repeated:
        replace_months(spark, spread_by_month(both), path, months)
        return
    with staged(last_of_each_key(both), "merged") as rows:
        replace_months(spark, spread_by_month(rows), path, months)


def publish_topic(
    spark: SparkSession,
    input_path: str,
    topic: Topic,
    limit: int | None = None,
    skip_corrupt: bool = False,
) -> None:
    """All rows of a raw month, or the first ``limit``, onto a topic.

    Each message is named by its input and its place there, so publishing again, after a
    crash or with corrected rows, replaces records and adds none. Rows beyond the end of a
    corrected, shorter input stay.
    """
    key = {"message_key": message_key(input_path, scanned_path(), F.col("_metadata.row_index"))}
    if limit:
        raw = read_raw(spark, input_path, skip_corrupt=skip_corrupt)
        rows = first_rows(raw, limit).withColumns(key)
    else:
        rows = read_inputs(spark, [input_path], skip_corrupt, more=key)[input_path]
    topic.write(encode(rows, key="message_key"))


def record_counts(
    spark: SparkSession,
    counted: dict[str, int],
    warehouse: Warehouse,
    run: tuple[str, int] | None = None,
) -> None:
    """The scorecard of rows counted while they were written, added as by the jobs that scan.

    It is that of what was written: of all Silver after a full build, of some months
    after a build of these, of one month of Bronze after its ingest.
    """
    names = list(counted)
    schema = ", ".join(f"`{name}` bigint" for name in names)
    frame = spark.createDataFrame([tuple(counted[name] for name in names)], schema)
    warehouse.record(scored(frame, *(run or new_run())), "dq_results")


def score_silver(
    spark: SparkSession,
    silver_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    run: tuple[str, int] | None = None,
) -> None:
    """Quality of Silver, added to the results of earlier runs; a run is added once."""
    card = profile(read_silver(spark, silver_base, dataset), *(run or new_run()))
    warehouse.record(card, "dq_results")


def score_bronze(
    spark: SparkSession,
    bronze_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    run: tuple[str, int] | None = None,
) -> None:
    """Quality of Bronze, before its filters, added to those of earlier runs; a run is added once."""
    card = profile(read_bronze(spark, bronze_base, dataset), *(run or new_run()))
    warehouse.record(card, "dq_results")


def evaluate_gold(
    spark: SparkSession,
    gold_base: str,
    warehouse: Warehouse,
    run: tuple[str, int] | None = None,
) -> None:
    """Totals over Gold, added to the metrics of earlier runs; a run is added once."""
    metrics = summarise_gold(read_gold_or_empty(spark, gold_base), *(run or new_run()))
    warehouse.record(metrics, "metrics_pipeline_runs")


def load_zone_lookup(spark: SparkSession, csv_path: str, warehouse: Warehouse) -> None:
    """The zone CSV as the whole content of its table."""
    warehouse.replace(read_zone_csv(spark, csv_path), "taxi_zone_lookup")
