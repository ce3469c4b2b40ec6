"""Queries over published tables."""

from __future__ import annotations

import random

import pytest
from helpers import rows, trips_frame

from farelake.operators import (
    clean_trips,
    failed_runs,
    latest_run,
    monthly_kpis,
    months_of_year,
    negative_kpis,
    null_kpis,
    outlier_months,
    pk_violations,
    recent_months,
    recent_runs,
    reconcile,
    row_counts,
    to_table,
)
from farelake.schemas import DQ_RESULTS, FACT_TRIPS_MONTHLY
from farelake.sinks import FileWarehouse, JdbcWarehouse, register_views


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [("b", 10, 1), ("c", 10, 0), ("a", 11, 0), ("d", 9, 1)], "run_id string, run_epoch long, passed int"
    )


def test_latest_run_breaks_ties_by_id(runs):
    assert [r.run_id for r in recent_runs(runs, 3).collect()] == ["a", "c", "b"]
    assert latest_run(runs).first().run_id == "a"
    assert latest_run(runs.where("run_epoch = 10")).first().run_id == "c"


def test_failed_runs(runs):
    assert rows(failed_runs(runs).select("run_id")) == [("a",), ("c",)]


@pytest.fixture
def gold(spark):
    data = [(y, m, 10 + m, float(m), 1.0, 2.0) for y in (2022, 2023) for m in range(1, 13)]
    return spark.createDataFrame(data, FACT_TRIPS_MONTHLY)


def test_recent_months(gold):
    found = [(r.year, r.month) for r in recent_months(gold).collect()]
    assert found == [(2023, m) for m in range(12, 2, -1)]


def test_months_of_year(gold):
    assert rows(months_of_year(gold, 2022).select("month")) == sorted([(m,) for m in range(1, 13)], key=repr)


def test_outliers_exceed_a_multiple_of_the_mean(spark):
    data = [(2023, m, t, 0.0, 0.0, 0.0) for m, t in ((1, 10), (2, 10), (3, 10), (4, 10), (5, 200), (6, 30))]
    gold = spark.createDataFrame(data, FACT_TRIPS_MONTHLY)
    assert [r.month for r in outlier_months(gold).collect()] == [5]
    assert [r.month for r in outlier_months(gold, 0.5).collect()] == [5, 6]


def test_null_and_negative_kpis(spark):
    data = [
        (None, None, 1, 1.0, 1.0, 1.0),
        (2023, None, None, -1.0, None, 1.0),
        (2023, 2, 3, 0.0, -0.5, 1.0),
        (2023, 3, 3, None, None, 1.0),
    ]
    gold = spark.createDataFrame(data, FACT_TRIPS_MONTHLY)
    assert tuple(null_kpis(gold).first()) == (1, 2, 1)
    assert negative_kpis(gold).count() == 2


def test_layers_reconcile(spark):
    bronze = trips_frame(
        spark, [("2023-01-01T00:00:00", d, 1.0, 0.0) for d in (1.0, 2.0, 0.0, None)] + [(None, 1.0, 1.0, 0.0)]
    )
    silver = clean_trips(bronze)
    gold = monthly_kpis(silver)
    assert tuple(reconcile(bronze, silver, gold).first()) == (5, 3, 2, 3, True)
    assert tuple(reconcile(bronze, silver, gold.where("year IS NOT NULL")).first()) == (5, 3, 2, 2, False)
    assert tuple(reconcile(bronze, silver.where("false"), gold.where("false")).first()) == (5, 0, 5, 0, True)
    assert rows(row_counts({"bronze": bronze, "gold": gold})) == [("bronze", 5), ("gold", 2)]


def test_pk_violations_against_brute_force(spark):
    random.seed(7)
    data = [(0 if i % 3 == 0 else random.randrange(40), random.choice([None, 1, 2])) for i in range(300)]
    expected = {key: data.count(key) for key in set(data) if data.count(key) > 1}
    frame = spark.createDataFrame(data, "a int, b int").repartition(5)
    assert {(r.a, r.b): r.n for r in pk_violations(frame, ["a", "b"]).collect()} == expected


def test_table_contract_orders_and_checks_columns(spark, gold):
    shuffled = gold.select("trips", "month", "year", "avg_distance", "total_tip", "total_fare", "trips")
    ordered = to_table(gold.select(*reversed(gold.columns)), "fact_trips_monthly")
    assert ordered.columns == FACT_TRIPS_MONTHLY.names
    with pytest.raises(Exception):
        to_table(shuffled, "fact_trips_monthly").collect()
    with pytest.raises(Exception):
        to_table(gold.withColumn("trips", gold.total_fare.cast("string")), "fact_trips_monthly").collect()


def test_file_warehouse_replaces_and_appends(spark, base, gold):
    warehouse = FileWarehouse(base)
    for _ in range(2):
        warehouse.replace(gold, "fact_trips_monthly")
    assert warehouse.read(spark, "fact_trips_monthly").count() == 24
    record = spark.createDataFrame([("a", 1, 1, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0, 1)], DQ_RESULTS)
    for _ in range(2):
        warehouse.append(record, "dq_results")
    assert warehouse.read(spark, "dq_results").count() == 2


def test_views_answer_sql(spark, base, gold):
    warehouse = FileWarehouse(base)
    warehouse.replace(gold, "fact_trips_monthly")
    scores = [(name, epoch, 1, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0, 1) for name, epoch in (("a", 1), ("b", 2))]
    warehouse.append(spark.createDataFrame(scores, DQ_RESULTS), "dq_results")
    register_views(spark, warehouse, ["fact_trips_monthly", "dq_results"])
    assert spark.sql("SELECT run_id FROM v_latest_dq").first()[0] == "b"
    top = spark.sql("SELECT year, month FROM fact_trips_monthly ORDER BY year DESC, month DESC LIMIT 1")
    assert tuple(top.first()) == (2023, 12)


def test_jdbc_options_and_password():
    warehouse = JdbcWarehouse("jdbc:postgresql://host:5432/db", "user", "secret")
    options = warehouse.options("dq_results")
    assert options["dbtable"] == "public.dq_results"
    assert options["driver"] == "org.postgresql.Driver"
    assert "secret" not in repr(warehouse)


def test_jdbc_modes(spark, gold, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    seen = []
    for name in ("format", "mode", "option", "options"):
        original = getattr(DataFrameWriter, name)

        def spy(self, *args, _name=name, _original=original, **kwargs):
            seen.append((_name, args, kwargs))
            return _original(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, name, spy)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.append(("save", (), {})))
    warehouse = JdbcWarehouse("jdbc:x", "u", "p")
    warehouse.replace(gold, "fact_trips_monthly")
    assert ("format", ("jdbc",), {}) in seen and ("mode", ("overwrite",), {}) in seen
    assert ("option", ("truncate", True), {}) in seen and seen[-1][0] == "save"
    seen.clear()
    warehouse.append(gold, "fact_trips_monthly")
    assert ("mode", ("append",), {}) in seen and seen[-1][0] == "save"
