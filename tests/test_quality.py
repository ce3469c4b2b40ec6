"""Quality scorecard and run metrics."""

from __future__ import annotations

import pytest
from helpers import rows, trips_frame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from farelake.operators import Rule, clean_trips, monthly_kpis, profile, summarise_gold
from farelake.plans import evaluate_gold, new_run, score_silver
from farelake.schemas import DQ_RESULTS, GOLD, METRICS_PIPELINE_RUNS
from farelake.sinks import FileWarehouse, write_months
from farelake.sources import read_gold_or_empty

DAY = "2023-01-15T10:00:00"


def types(schema):
    return [(f.name, f.dataType) for f in schema]


def frame(spark, good, null_distance=0, bad_fare=0):
    return trips_frame(
        spark,
        [(DAY, 1.0, 1.0, 0.0)] * good
        + [(DAY, None, 1.0, 0.0)] * null_distance
        + [(DAY, 1.0, -1.0, 0.0)] * bad_fare,
    )


def test_scorecard_fits_its_table(spark):
    scored = profile(frame(spark, 1), "a", 5)
    assert types(scored.schema) == types(DQ_RESULTS)


@pytest.mark.parametrize(
    ("good", "null_distance", "bad_fare", "passed"),
    [(95, 5, 0, 1), (94, 6, 0, 0), (98, 0, 2, 1), (97, 0, 3, 0), (93, 5, 2, 1)],
)
def test_limits_are_inclusive(spark, good, null_distance, bad_fare, passed):
    row = profile(frame(spark, good, null_distance, bad_fare), "a", 5).first()
    assert (row.rows_total, row.null_trip_distance, row.bad_fare, row.passed) == (
        100,
        null_distance,
        bad_fare,
        passed,
    )
    assert row.rate_null_distance == null_distance / 100
    assert row.rate_bad_fare == bad_fare / 100


def test_nothing_fails(spark):
    row = profile(trips_frame(spark, []), "a", 5).first()
    assert row.rows_total == 0 and row.passed == 0
    assert [row[name] for name in row.__fields__ if name.startswith("rate_")] == [1.0] * 4


def test_nan_is_neither_null_nor_bad(spark):
    row = profile(trips_frame(spark, [(DAY, float("nan"), float("nan"), 0.0)]), "a", 5).first()
    assert (row.null_trip_distance, row.bad_distance, row.bad_fare, row.passed) == (0, 0, 0, 1)


def test_rules_are_parameters(spark):
    rules = [Rule("long_trips", "rate_long_trips", F.col("trip_distance") > 100, 0.5)]
    row = profile(trips_frame(spark, [(DAY, d, 1.0, 0.0) for d in (1.0, 200.0)]), "a", 5, rules).first()
    assert row.asDict() == {
        "run_id": "a",
        "run_epoch": 5,
        "rows_total": 2,
        "long_trips": 1,
        "rate_long_trips": 0.5,
        "passed": 1,
    }


def gold_rows(spark, values):
    return spark.createDataFrame(values, "trips bigint, total_fare double, total_tip double, avg_distance double, year int, month int")


def test_metrics_weigh_months_equally_and_count_the_null_month(spark):
    gold = gold_rows(
        spark,
        [(1000, 10.1, 1.0, 2.0, 2023, 1), (1, 0.2, 0.5, 4.0, 2023, 2), (1, 0.1, 0.5, 9.0, None, None)],
    )
    metrics = summarise_gold(gold, "a", 5)
    assert types(metrics.schema) == types(METRICS_PIPELINE_RUNS)
    assert tuple(metrics.first()) == ("a", 5, 3, 3, 1002.0, 10.4, 2.0, 5.0)


def test_months_are_pairs(spark):
    gold = gold_rows(spark, [(1, 1.0, 1.0, 1.0, y, m) for y, m in ((2023, 1), (2023, 1), (2024, 1), (2024, None))])
    row = summarise_gold(gold, "a", 5).first()
    assert (row.months_covered, row.rows_gold) == (3, 4)


def test_missing_gold_gives_zeros(spark, base):
    warehouse = FileWarehouse(f"{base}/warehouse")
    evaluate_gold(spark, f"{base}/nowhere", warehouse, run=("a", 5))
    assert rows(warehouse.read(spark, "metrics_pipeline_runs")) == [("a", 5, 0, 0, 0.0, 0.0, 0.0, 0.0)]


def test_gold_without_partitions_gives_zeros(spark, base):
    empty = spark.createDataFrame([], GOLD)
    write_months(empty, f"{base}/kpis_trips_monthly", replace="all")
    assert tuple(summarise_gold(read_gold_or_empty(spark, base), "a", 5).first())[2:] == (0, 0, 0.0, 0.0, 0.0, 0.0)


def test_other_read_errors_are_raised(spark):
    with pytest.raises(Exception) as error:
        read_gold_or_empty(spark, "nosuchscheme://host/gold")
    assert not isinstance(error.value, AnalysisException) or "PATH_NOT_FOUND" not in str(error.value)


def test_runs_are_added_to_earlier_ones(spark, base):
    silver = clean_trips(frame(spark, 3))
    write_months(silver, f"{base}/silver/yellow_tripdata", replace="all")
    write_months(monthly_kpis(silver), f"{base}/gold/kpis_trips_monthly", replace="all")
    warehouse = FileWarehouse(f"{base}/warehouse")
    for _ in range(2):
        score_silver(spark, f"{base}/silver", warehouse)
        evaluate_gold(spark, f"{base}/gold", warehouse)
    scores = warehouse.read(spark, "dq_results")
    assert rows(scores.select("rows_total", "passed")) == [(3, 1), (3, 1)]
    assert scores.select("run_id").distinct().count() == 2
    assert warehouse.read(spark, "metrics_pipeline_runs").count() == 2


def test_run_ids_differ():
    first, second = new_run(), new_run()
    assert first[0] != second[0] and isinstance(first[1], int)
