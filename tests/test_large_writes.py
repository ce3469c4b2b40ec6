"""How much of a task's rows a write holds at once, from the event log of a session of its own."""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

#: Three months, in turn from row to row, in one task of a session that logs its tasks.
_SESSION = """
import sys
sys.path[:0] = [sys.argv[1], sys.argv[1] + "/tests"]
from pyspark.sql import SparkSession, functions as F
from farelake.sinks import append_months, write_months
base = sys.argv[2]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", "false")
    .config("spark.checkpoint.dir", base + "/scratch")
    .config("spark.eventLog.dir", "file://" + base + "/events").getOrCreate()
)
ids = spark.range(0, 300_000, 1, 1).withColumn("year", F.lit(2023))
rows = ids.withColumn("month", (F.col("id") % 3).cast("int") + 1)
"""


def largest_task(base, script):
    """MB of execution memory of the largest task that wrote files."""
    os.makedirs(f"{base}/events")
    made = subprocess.run(
        [sys.executable, "-c", f"{_SESSION}\n{script}\nspark.stop()", ROOT, base],
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert made.returncode == 0, made.stderr[-2000:]
    peaks = []
    for path in glob.glob(f"{base}/events/*"):
        with open(path, encoding="utf-8") as lines:
            for event in map(json.loads, lines):
                metrics = event.get("Task Metrics") or {}
                if metrics.get("Output Metrics", {}).get("Bytes Written"):
                    peaks.append(metrics["Peak Execution Memory"] / 1e6)
    return max(peaks)


@pytest.mark.parametrize(
    "write",
    [
        'append_months(rows, base + "/t")',
        'write_months(rows, base + "/t", replace="all")',
    ],
)
def test_a_write_holds_no_task_as_a_whole(spark, base, write):
    assert largest_task(base, write) < 1
    stored = spark.read.parquet(f"{base}/t")
    assert [r["count"] for r in stored.groupBy("month").count().collect()] == [100_000] * 3
    assert stored.distinct().count() == 300_000


def test_the_setting_is_left_as_it_was(spark, base):
    from farelake.sinks import side_by_side

    name = "spark.sql.maxConcurrentOutputFileWriters"
    for before in (None, "7"):
        if before:
            spark.conf.set(name, before)
        with side_by_side(spark):
            assert spark.conf.get(name) == "128"
        assert spark.conf.get(name, None) == before
    spark.conf.unset(name)
