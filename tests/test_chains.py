"""Chains of jobs end to end, and the command line over them."""

from __future__ import annotations

import re

import pytest
from helpers import parquet_files, plan, rows, when

from farelake import __main__ as cli
from farelake.plans import (
    GoldStatus,
    build_silver,
    ingest_bronze,
    ingest_topic,
    load_zone_lookup,
    run_batch,
    run_batch_all,
    run_evaluation,
    run_topic_batch,
)
from farelake.schemas import TOPIC_DATASET
from farelake.session import scratch_path
from farelake.sinks import FileWarehouse
from farelake.sources import read_bronze, read_silver
from farelake.streaming import FileTopic, KafkaTopic


@pytest.fixture
def raw(spark, base):
    data = [
        (2, when("2023-01-05T08:00:00"), 1.5, 10.0, 1.0),
        (1, when("2023-01-06T08:00:00"), 2.5, 20.0, 2.0),
        (1, when("2022-12-31T23:50:00"), 3.0, 30.0, 3.0),
        (1, when("2023-01-07T08:00:00"), 0.0, 5.0, 0.0),
        (1, when("2023-01-08T08:00:00"), 4.0, -5.0, 0.0),
    ]
    path = f"{base}/raw/yellow_tripdata_2023-01.parquet"
    spark.createDataFrame(
        data,
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, trip_distance double, fare_amount double, tip_amount double",
    ).coalesce(1).write.parquet(path)
    return path


FACT = [(2022, 12, 1, 30.0, 3.0, 3.0), (2023, 1, 2, 30.0, 3.0, 2.0)]


def bases(base):
    return f"{base}/bronze", f"{base}/silver", f"{base}/gold", FileWarehouse(f"{base}/warehouse")


def test_batch_twice_gives_the_same(spark, base, raw):
    for _ in range(2):
        assert run_batch(spark, raw, *bases(base)) is GoldStatus.WRITTEN
        assert rows(bases(base)[3].read(spark, "fact_trips_monthly")) == FACT


def test_topic_chain_equals_the_batch_on_what_messages_carry(spark, base, raw):
    topic = FileTopic(f"{base}/topic")
    assert run_topic_batch(spark, raw, topic, *bases(base)) is GoldStatus.WRITTEN
    assert rows(bases(base)[3].read(spark, "fact_trips_monthly")) == FACT
    bronze = read_bronze(spark, f"{base}/bronze", TOPIC_DATASET)
    assert rows(bronze.groupBy("year", "month").count()) == [
        (2022, 12, 1),
        (2023, 1, 4),
    ]


def test_topic_chain_caps_what_it_publishes(spark, base, raw):
    topic = FileTopic(f"{base}/topic")
    run_topic_batch(spark, raw, topic, *bases(base), limit=2)
    assert topic.read(spark).count() == 2
    assert rows(bases(base)[3].read(spark, "fact_trips_monthly")) == [(2023, 1, 2, 30.0, 3.0, 2.0)]


def test_evaluation_scores_and_summarises(spark, base, raw):
    bronze, silver, gold, warehouse = bases(base)
    run_batch(spark, raw, bronze, silver, gold, warehouse)
    run_evaluation(spark, silver, gold, warehouse)
    assert rows(warehouse.read(spark, "dq_results").select("rows_total", "passed")) == [(3, 1)]
    metrics = warehouse.read(spark, "metrics_pipeline_runs").drop("run_id", "run_epoch")
    assert rows(metrics) == [(2, 2, 3.0, 60.0, 6.0, 2.5)]


ZONES = 'LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n2,Queens,Jamaica Bay,Boro Zone\n'


def test_zones_are_reloaded_whole(spark, base, tmp_path):
    (tmp_path / "zones.csv").write_text(ZONES)
    warehouse = FileWarehouse(f"{base}/warehouse")
    for _ in range(2):
        load_zone_lookup(spark, f"{base}/zones.csv", warehouse)
    assert rows(warehouse.read(spark, "taxi_zone_lookup")) == [
        (1, "EWR", "Newark, Airport", "EWR"),
        (2, "Queens", "Jamaica Bay", "Boro Zone"),
    ]


def test_zone_ids_must_be_numbers_and_headers_must_match(spark, base, tmp_path):
    (tmp_path / "bad.csv").write_text(ZONES.replace("\n2,", "\ntwo,"))
    (tmp_path / "order.csv").write_text(ZONES.replace("LocationID,Borough", "Borough,LocationID"))
    for name in ("bad.csv", "order.csv"):
        with pytest.raises(Exception):
            load_zone_lookup(spark, f"{base}/{name}", FileWarehouse(f"{base}/warehouse"))


def test_command_line_runs_the_chain(spark, base, raw, capsys, tmp_path):
    layers = [f"--{n}_base={base}/{n}" for n in ("bronze", "silver", "gold")]
    month = [f"--raw_base={base}/raw", "--year=2023", "--month=1"]
    warehouse = f"--warehouse_base={base}/warehouse"

    def run(*argv):
        return cli.run(spark, cli._parser().parse_args(argv))

    assert run("batch", *layers, *month, warehouse) is GoldStatus.WRITTEN
    run("evaluation", *layers[1:], warehouse)
    (tmp_path / "zones.csv").write_text(ZONES)
    run("zones", f"--input={base}/zones.csv", warehouse)
    stored = FileWarehouse(f"{base}/warehouse")
    assert rows(stored.read(spark, "fact_trips_monthly")) == FACT
    assert stored.read(spark, "taxi_zone_lookup").count() == 2
    run("bronze", layers[0], f"--input={raw}")
    run("bronze-all", layers[0], f"--raw_base={base}/raw")
    run("silver", *layers[:2])
    run("gold", *layers[1:], warehouse)
    run("dq", layers[1], warehouse)
    run("evaluate", layers[2], warehouse)
    assert rows(stored.read(spark, "fact_trips_monthly")) == FACT
    assert stored.read(spark, "dq_results").count() == 2


def test_command_line_asks_for_what_is_missing(spark, base):
    for argv in (["dq", f"--silver_base={base}"], ["bronze", f"--bronze_base={base}"]):
        with pytest.raises(SystemExit):
            cli.run(spark, cli._parser().parse_args(argv))


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second


def test_topic_chain_leaves_the_batch_months_alone(spark, base, raw):
    run_batch(spark, raw, *bases(base))
    before = rows(read_bronze(spark, f"{base}/bronze"))
    assert len(before) == 5 and {r[0] for r in before} == {1.0, 2.0}
    run_topic_batch(spark, raw, FileTopic(f"{base}/topic"), *bases(base))
    assert rows(read_bronze(spark, f"{base}/bronze")) == before


def test_a_topic_read_in_part_is_refused(spark, base):
    for topic in (KafkaTopic(starting_offsets="latest"), FileTopic(f"{base}/topic", whole=False)):
        with pytest.raises(ValueError, match="whole topic"):
            ingest_topic(spark, topic, f"{base}/bronze")
    assert KafkaTopic().whole


def test_empty_or_repeated_zone_ids_leave_the_table(spark, base, tmp_path):
    warehouse = FileWarehouse(f"{base}/warehouse")
    (tmp_path / "good.csv").write_text(ZONES)
    load_zone_lookup(spark, f"{base}/good.csv", warehouse)
    for name, row in (("null", ",x,y,z\n"), ("twice", "2,x,y,z\n"), ("text", "two,x,y,z\n")):
        (tmp_path / f"{name}.csv").write_text(ZONES + row)
        with pytest.raises(Exception):
            load_zone_lookup(spark, f"{base}/{name}.csv", warehouse)
        assert warehouse.read(spark, "taxi_zone_lookup").count() == 2


SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, trip_distance double, "
    "fare_amount double, tip_amount double"
)


def month_file(spark, base, month, trips):
    """A raw month of (pickup, tip) trips."""
    path = f"{base}/raw/yellow_tripdata_2023-{month:02d}.parquet"
    data = [(1, when(t) if t else None, 1.0, 2.0, tip) for t, tip in trips]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def test_one_new_month_equals_a_full_rebuild(spark, base):
    """Strays in other files, null pickups, and months that lose all their rows."""
    files = {
        1: [("2023-01-05T00:00:00", 1.0), ("2023-02-01T00:00:00", 2.0), ("2022-07-01T00:00:00", 9.0)],
        2: [("2023-02-05T00:00:00", 3.0), ("2023-01-31T23:59:59", 4.0), (None, 5.0)],
        3: [("2023-03-05T00:00:00", 6.0), (None, 7.0)],
    }
    for month, trips in files.items():
        month_file(spark, base, month, trips)
    layers, undated = bases(base), (1900, 1)
    run_batch_all(spark, f"{base}/raw", *layers, undated=undated)
    untouched = parquet_files(f"{base}/silver/yellow_tripdata/year=2023/month=3")
    path = month_file(spark, base, 1, [("2023-02-02T00:00:00", 8.0), ("2023-01-06T00:00:00", 1.5)])
    assert run_batch(spark, path, *layers, undated=undated) is GoldStatus.WRITTEN
    assert parquet_files(f"{base}/silver/yellow_tripdata/year=2023/month=3") == untouched
    other = bases(f"{base}/other")
    run_batch_all(spark, f"{base}/raw", *other, undated=undated)
    silver = [rows(read_silver(spark, s)) for s in (layers[1], other[1])]
    assert silver[0] == silver[1] and len(silver[0]) == 7
    facts = [rows(w.read(spark, "fact_trips_monthly")) for w in (layers[3], other[3])]
    assert facts[0] == facts[1] and [f[:3] for f in facts[0]] == [
        (1900, 1, 2),
        (2023, 1, 2),
        (2023, 2, 2),
        (2023, 3, 1),
    ]
    again = month_file(spark, base, 3, [("2023-03-06T00:00:00", 6.5)])
    run_batch(spark, again, *layers, undated=undated)
    assert rows(layers[3].read(spark, "fact_trips_monthly"))[0][:3] == (1900, 1, 1)
    run_batch(spark, again, *layers, undated=undated, rebuild=True)
    assert rows(layers[3].read(spark, "fact_trips_monthly"))[0][:3] == (1900, 1, 1)


def test_silver_of_one_month_pushes_its_range(spark, base, capsys):
    from farelake.plans.jobs import dated_in, _picked_up_in

    ingest_bronze(spark, month_file(spark, base, 1, [("2023-01-05T00:00:00", 1.0)]), base)
    build_silver(spark, base, f"{base}/silver")
    frame = spark.read.schema("tpep_pickup_datetime timestamp").parquet(f"{base}/yellow_tripdata")
    text = plan(frame.where(_picked_up_in({(2023, 1)})), capsys)
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text and "LessThan(" in text
    text = plan(read_silver(spark, f"{base}/silver").where(dated_in({(2023, 1), (None, None)})), capsys)
    assert re.search(r"PartitionFilters: \[.*2023.*isnull\(year", text)


def test_corrupt_files_are_named_by_the_build(spark, base, raw):
    ingest_bronze(spark, raw, f"{base}/bronze")
    broken = f"{base}/bronze/yellow_tripdata/year=2023/month=1/broken"
    with open(broken, "wb") as file:
        file.write(b"PAR1 not a file PAR1")
    with pytest.raises(Exception):
        build_silver(spark, f"{base}/bronze", f"{base}/silver")
    built = build_silver(spark, f"{base}/bronze", f"{base}/silver", skip_corrupt=True)
    assert built.skipped == [f"file:{broken}"] and read_silver(spark, f"{base}/silver").count() == 3


def test_command_line_defaults_lose_nothing(spark, base, raw):
    parse = cli._parser().parse_args
    args = parse(["publish", f"--input={raw}"])
    assert args.limit is None and args.num_partitions is None and args.failOnDataLoss
    assert not parse(["publish", f"--input={raw}", "--no-failOnDataLoss"]).failOnDataLoss
    cli.run(spark, parse(["bronze", f"--input={raw}", f"--bronze_base={base}/bronze"]))
    dq = ["dq", "--layer=bronze", f"--bronze_base={base}/bronze", f"--warehouse_base={base}/w"]
    cli.run(spark, parse(dq))
    assert FileWarehouse(f"{base}/w").read(spark, "dq_results").first().rows_total == 5
