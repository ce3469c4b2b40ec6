"""Jobs in the order a run needs them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.months import month_of_name
from farelake.operators.clean import PICKUP
from farelake.plans.jobs import (
    GoldStatus,
    build_gold,
    build_silver,
    evaluate_gold,
    ingest_bronze,
    ingest_bronze_months,
    ingest_topic,
    merge_messages,
    pickup_months,
    publish_topic,
    score_silver,
)
from farelake.plans.ledger import Ledger, Month
from farelake.schemas import DEFAULT_DATASET, TOPIC_DATASET
from farelake.sinks import Warehouse
from farelake.sources import read_bronze, read_gold, read_inputs, read_silver
from farelake.streaming import Topic


def _exists(read, *args) -> bool:
    try:
        read(*args)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _months_in_bronze(
    spark: SparkSession, bronze_base: str, dataset: str, pickup: str, month: Month
) -> set[Month]:
    """Pickup months of what a month of Bronze holds now."""
    if not _exists(read_bronze, spark, bronze_base, dataset):
        return set()
    bronze = read_bronze(spark, bronze_base, dataset, rename={pickup: PICKUP})
    here = F.lit(True)
    for name, value in zip(("year", "month"), month):
        here = here & F.col(name).eqNullSafe(F.lit(value).cast("int"))
    return pickup_months(bronze.where(here))


def start_batch(
    spark: SparkSession,
    input_path: str,
    bronze_base: str,
    silver_base: str,
    gold_base: str,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
    skip_corrupt: bool = False,
    rebuild: bool = False,
) -> None:
    """One raw month into Bronze, after its months have been written down as owed.

    Where Silver and Gold exist, these are the pickup months of the new file and of the
    Bronze month it replaces; else, or with ``rebuild``, all months.
    """
    stored = _exists(read_silver, spark, silver_base, dataset) and _exists(
        read_gold, spark, gold_base
    )
    months = None
    if stored and not rebuild:
        month = month_of_name(input_path)
        months = _months_in_bronze(spark, bronze_base, dataset, pickup, month)
        raw = read_inputs(spark, [input_path], skip_corrupt)[input_path]
        months |= pickup_months(raw, pickup)
    Ledger(spark, silver_base, dataset).note(months)
    ingest_bronze(spark, input_path, bronze_base, dataset, skip_corrupt)


def finish_batch(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
    undated: Month | None = None,
    skip_corrupt: bool = False,
) -> GoldStatus:
    """All months owed into Silver and Gold, whichever run wrote them down.

    They stay owed until Gold is published: a run that ends before is made up for
    by the next. An empty Silver leaves Gold as it is, and so its months owed.
    """
    ledger = Ledger(spark, silver_base, dataset)
    owed = ledger.owed()
    months = None if owed.months is None else set(owed.months)
    build_silver(spark, bronze_base, silver_base, dataset, pickup, skip_corrupt, months)
    status = build_gold(spark, silver_base, gold_base, warehouse, dataset, undated, months)
    if status is GoldStatus.WRITTEN:
        ledger.strike(owed)
    return status


def run_batch(
    spark: SparkSession,
    input_path: str,
    bronze_base: str,
    silver_base: str,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
    undated: Month | None = None,
    skip_corrupt: bool = False,
    rebuild: bool = False,
) -> GoldStatus:
    """One raw month through Bronze, Silver and Gold.

    Where Silver and Gold exist, only months are rebuilt that the new file or the
    Bronze month it replaces has pickups in, and those an earlier run left owed.
    ``rebuild`` builds them all, as is needed where Bronze was changed by other means.
    """
    layers = bronze_base, silver_base, gold_base
    start_batch(spark, input_path, *layers, dataset, pickup, skip_corrupt, rebuild)
    return finish_batch(spark, *layers, warehouse, dataset, pickup, undated, skip_corrupt)


def run_batch_all(
    spark: SparkSession,
    raw_base: str,
    bronze_base: str,
    silver_base: str,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    pickup: str = PICKUP,
    undated: Month | None = None,
    skip_corrupt: bool = False,
) -> GoldStatus:
    """All raw months of a dataset through Bronze, Silver and Gold."""
    Ledger(spark, silver_base, dataset).note(None)
    ingest_bronze_months(spark, raw_base, bronze_base, dataset, skip_corrupt)
    layers = bronze_base, silver_base, gold_base
    return finish_batch(spark, *layers, warehouse, dataset, pickup, undated, skip_corrupt)


def run_topic_batch(
    spark: SparkSession,
    input_path: str,
    topic: Topic,
    bronze_base: str,
    silver_base: str,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = TOPIC_DATASET,
    limit: int | None = None,
    undated: Month | None = None,
) -> GoldStatus:
    """One raw month onto a topic, and the topic through Bronze, Silver and Gold.

    Messages go into a dataset of their own: they lack columns that raw files have,
    and a topic may hold less than a month.
    """
    publish_topic(spark, input_path, topic, limit)
    ingest_topic(spark, topic, bronze_base, dataset)
    build_silver(spark, bronze_base, silver_base, dataset)
    return build_gold(spark, silver_base, gold_base, warehouse, dataset, undated)


def follow_topic(
    spark: SparkSession,
    topic: Topic,
    bronze_base: str,
    silver_base: str,
    gold_base: str,
    warehouse: Warehouse,
    checkpoint: str,
    dataset: str = TOPIC_DATASET,
    undated: Month | None = None,
) -> GoldStatus:
    """What a topic has got since the last run through Bronze, Silver and Gold.

    ``checkpoint`` is a folder that remembers what has been read; the first run reads all the
    topic holds. Each batch of the stream merges its messages into the months they touch, and
    Silver and Gold are then rebuilt for those months alone. A batch that is tried
    again, or a run after one that never ended, changes nothing that was done already. The result is that of
    replaying the whole topic, also for messages it no longer retains.
    """
    ledger = Ledger(spark, silver_base, dataset)
    if not (
        _exists(read_silver, spark, silver_base, dataset) and _exists(read_gold, spark, gold_base)
    ):
        ledger.note(None)

    def merge(messages: DataFrame, _: int) -> None:
        merge_messages(messages.sparkSession, messages, bronze_base, ledger, dataset)

    stream = topic.follow(spark).writeStream.foreachBatch(merge)
    stream = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return finish_batch(
        spark, bronze_base, silver_base, gold_base, warehouse, dataset, undated=undated
    )


def run_evaluation(
    spark: SparkSession,
    silver_base: str,
    gold_base: str,
    warehouse: Warehouse,
    dataset: str = DEFAULT_DATASET,
    runs: tuple[tuple[str, int], tuple[str, int]] | None = None,
) -> None:
    """Quality of Silver, then totals over Gold; ``runs`` names and dates the two records."""
    scored, summed = runs or (None, None)
    score_silver(spark, silver_base, warehouse, dataset, scored)
    evaluate_gold(spark, gold_base, warehouse, summed)
