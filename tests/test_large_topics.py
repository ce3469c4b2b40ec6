"""What following and replaying a topic costs: parses, sorts and filters in the plans, and disk."""

from __future__ import annotations

import glob
import re
import time

import pyarrow.parquet as pq
import pytest
from helpers import parquet_files, plan
from pyspark.sql import functions as F

from farelake.operators.clean import PICKUP
from farelake.plans import Ledger, ingest_messages, merge_messages
from farelake.plans.jobs import _older_records, _picked_up_in, replace_months
from farelake.sinks import staged
from farelake.streaming import FileTopic, message_key
from farelake.streaming.topic import trip_messages


def test_only_the_last_message_of_a_key_is_parsed(spark, capsys):
    rows = [("a#0", '{"fare_amount": 1.0}', 0), ("a#0", '{"fare_amount": 2.0}', 1), (None, "{}", 2)]
    envelope = spark.createDataFrame(rows, "key string, value string, offset bigint")
    records = trip_messages(envelope)
    nodes = plan(records, capsys).split("(1)", 1)[0].splitlines()
    window = next(i for i, line in enumerate(nodes) if "Window" in line)
    assert not any("WindowGroupLimit" in line for line in nodes)
    assert sum("Sort" in line for line in nodes) == 1
    assert window < next(i for i, line in enumerate(nodes) if "Sort" in line)
    found = {(r.message_offset, r.fare_amount) for r in records.collect()}
    assert found == {(1, 2.0), (2, None)}


def test_months_that_follow_one_another_are_one_range(spark, capsys):
    frame = spark.range(1).select(F.lit("2020-06-15").cast("timestamp").alias(PICKUP))
    months = {(year, month) for year in (2019, 2020) for month in range(1, 13)}
    found = str(_picked_up_in(months | {(2022, 12), (None, None)})._jc.toString())
    assert found.count(">=") == 2
    times = ["2018-12-31 23:59:59", "2019-01-01", "2020-12-31 23:59:59", "2021-01-01"]
    times += ["2022-11-30", "2022-12-31 10:00:00", "2023-01-01", None]
    frame = spark.createDataFrame([(t,) for t in times], "t string")
    frame = frame.select(F.col("t").cast("timestamp").alias(PICKUP), "t")
    kept = {r.t for r in frame.where(_picked_up_in(months | {(2022, 12), (None, None)})).collect()}
    assert kept == {times[1], times[2], times[5], None}
    assert not frame.where(_picked_up_in(set())).count()


def test_months_without_rows_any_more_are_seen_while_others_are_written(spark, base):
    rows = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2), (3, None, None)], "v int, year int, month int")
    months = {(2023, 1), (2023, 2), (None, None)}
    replace_months(spark, rows, f"{base}/t", months)
    replace_months(spark, rows.where("v = 2").replace(2, 5, "v"), f"{base}/t", months)
    schema = "v int, year int, month int"
    assert [tuple(r) for r in spark.read.schema(schema).parquet(f"{base}/t").collect()] == [(5, 2023, 2)]
    replace_months(spark, rows.where("v > 9"), f"{base}/t", months)
    assert spark.read.schema(schema).parquet(f"{base}/t").isEmpty()


def test_names_of_messages_stay_as_they_were(spark):
    paths = ["file:/a/m.parquet/part-0", "file:/m.parquet/m.parquet/d/p", "file:/a/m.parquet", "s3a://b/x"]
    frame = spark.createDataFrame([(p,) for p in paths], "p string")
    name = message_key("file:/a/m.parquet/", F.col("p"), F.lit(7))
    old = F.concat_ws("#", F.lit("m.parquet"), F.regexp_replace("p", r"^.*/\Qm.parquet\E/?", ""), F.lit(7))
    assert all(row.new == row.old for row in frame.select(name.alias("new"), old.alias("old")).collect())


def envelope(spark, since, until):
    """Messages named by number, a day apart."""
    day = F.date_format(F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")), "yyyy-MM-dd")
    value = F.format_string(
        '{"tpep_pickup_datetime": "%sT00:00:00", "fare_amount": %d.5}', day, F.col("id")
    )
    rows = spark.range(since, until, 1, 4)
    return rows.select(
        F.format_string("a#%d", "id").cast("binary").alias("key"), value.alias("value"),
        F.lit(until).cast("long").alias("offset"),
    )


def left_over(spark):
    """Files of shuffles and of scratch folders that are on the disk."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    scratch = spark.conf.get("spark.checkpoint.dir")
    made = glob.glob(f"{scratch}/farelake-me*")
    return {name for name in names if name.startswith("shuffle_")} | set(made)


def settled(spark, before):
    """What is left over once files have had the time to go."""
    until = time.time() + 10
    while (found := left_over(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return found


@pytest.mark.parametrize("way", ["ingest", "merge"])
def test_messages_leave_neither_shuffles_nor_scratch_behind(spark, base, way):
    before = left_over(spark)
    for since, until in ((0, 60), (30, 100)):
        messages = envelope(spark, since, until)
        if way == "ingest":
            ingest_messages(messages, base, "t")
        else:
            merge_messages(spark, messages, base, Ledger(spark, f"{base}/silver", "t"), "t")
    assert not settled(spark, before)
    stored = spark.read.parquet(f"{base}/t")
    fares = sorted(r.fare_amount for r in stored.select("fare_amount").collect())
    # By the first way months that come again hold what the second lot has of them alone.
    lost = 0 if way == "merge" else 30
    assert fares == [n + 0.5 for n in range(lost, 100)]


def test_records_are_exchanged_parsed_and_without_their_digest(spark, capsys):
    nodes = plan(trip_messages(envelope(spark, 0, 9)), capsys)
    (read,) = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", nodes)
    names = re.findall(r"(\w+)#\d+", read)
    assert {"fare_amount", "message_key"} <= set(names)
    assert "value" not in names and not any(name.startswith("_w") for name in names)


def test_keys_are_never_broadcast(spark, capsys):
    fresh = trip_messages(envelope(spark, 0, 50))
    with staged(fresh, "messages") as some, staged(fresh, "messages") as same:
        older = _older_records(some, same)
        assert older.count() == 50
        nodes = plan(older, capsys)
    assert "SortMergeJoin" in nodes and "Broadcast" not in nodes


def test_messages_in_files_are_compressed_well(spark, base):
    FileTopic(f"{base}/topic").write(envelope(spark, 0, 100))
    for path in parquet_files(f"{base}/topic"):
        assert pq.read_metadata(path).row_group(0).column(1).compression == "ZSTD"
