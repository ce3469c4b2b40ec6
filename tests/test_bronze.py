"""Bronze: drifting schemas, months from names, partial overwrites."""

from __future__ import annotations

import pytest
from helpers import by_file_month, parquet_files, rows, trips_frame, when
from pyspark.sql import functions as F

from farelake.functions import dataset_name, month_columns, month_file_name, month_of_name, month_path
from farelake.operators import conform
from farelake.plans import ingest_bronze, ingest_bronze_months
from farelake.schemas import BRONZE, PARTITION
from farelake.sinks import write_month, write_months
from farelake.sources import below, raw_inputs, read_bronze, schema_groups, skipped_files

DATASET = "yellow_tripdata"


def vendor(spark, kind, value, name="VendorID"):
    return spark.createDataFrame([(value, 2.5)], f"{name} {kind}, trip_distance double")


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("hdfs://host/raw/yellow_tripdata_2023-01.parquet", (2023, 1)),
        ("/raw/2020-05/green_tripdata_2019-12.parquet/", (2019, 12)),
        ("/raw/2020-05/trips.parquet", (None, None)),
        ("x_2021-02_2022-03.parquet", (2021, 2)),
    ],
)
def test_month_of_name(spark, path, expected):
    assert month_of_name(path) == expected
    name = F.lit(path.rstrip("/").rsplit("/", 1)[-1])
    assert tuple(spark.range(1).select(*month_columns(name).values()).first()) == expected


def test_names_of_months():
    assert month_file_name("green", 2024, 3) == "green_tripdata_2024-03.parquet"
    assert month_path("s3a://b/raw/", "fhv", 2024, 11) == "s3a://b/raw/fhv_tripdata_2024-11.parquet"
    with pytest.raises(ValueError):
        dataset_name("blue")


def test_integer_widths_lose_no_row(spark, base):
    frames = [vendor(spark, "int", 1), vendor(spark, "bigint", 2), vendor(spark, "double", 3.0)]
    for month, frame in enumerate(frames, 1):
        write_month(frame, f"{base}/{DATASET}", 2023, month)
    bronze = read_bronze(spark, base)
    assert bronze.schema.names == BRONZE.names + PARTITION.names
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE.fields + PARTITION.fields]
    assert rows(bronze.select("VendorID", "year", "month")) == [
        (1.0, 2023, 1),
        (2.0, 2023, 2),
        (3.0, 2023, 3),
    ]


def test_widths_within_one_month_lose_no_row(spark, base):
    leaf = f"{base}/{DATASET}/year=2023/month=1"
    vendor(spark, "int", 1).write.parquet(leaf)
    vendor(spark, "bigint", 2).write.mode("append").parquet(leaf)
    vendor(spark, "double", 3.0).write.mode("append").parquet(leaf)
    assert rows(read_bronze(spark, base).select("VendorID", "year", "month")) == [
        (1.0, 2023, 1),
        (2.0, 2023, 1),
        (3.0, 2023, 1),
    ]


def test_column_case_text_datetimes_and_missing_columns(spark, base):
    old = spark.createDataFrame(
        [("2023-01-05T10:00:00", 1.25), ("not a time", 1.5)],
        "tpep_pickup_datetime string, Airport_fee double",
    )
    write_month(old, f"{base}/{DATASET}", 2023, 1)
    new = spark.createDataFrame([(when("2023-02-05T10:00:00"), 2)], "TPEP_PICKUP_DATETIME timestamp_ntz, x int")
    write_month(new, f"{base}/{DATASET}", 2023, 2)
    bronze = read_bronze(spark, base).select("tpep_pickup_datetime", "airport_fee", "month")
    assert rows(bronze) == [
        (None, 1.5, 1),
        (when("2023-01-05T10:00:00"), 1.25, 1),
        (when("2023-02-05T10:00:00"), None, 2),
    ]


def test_same_schema_is_one_group(spark, base):
    for month in (1, 2, 3):
        write_month(vendor(spark, "bigint", month), f"{base}/{DATASET}", 2023, month)
    write_month(vendor(spark, "int", 4), f"{base}/{DATASET}", 2023, 4)
    root = f"{base}/{DATASET}"
    leaves = [f"{root}/year=2023/month={m}" for m in (1, 4, 2, 3)]
    groups = schema_groups(spark, leaves, root)
    assert sorted(len(paths) for _, paths in groups) == [1, 3]


def test_empty_bronze_has_the_contract(spark, base):
    write_months(by_file_month(trips_frame(spark, []), 2023, 1), f"{base}/{DATASET}", replace="all")
    bronze = read_bronze(spark, base)
    assert bronze.schema.names == BRONZE.names + PARTITION.names
    assert bronze.count() == 0


def test_conform_passes_matching_types_bare(spark):
    frame = spark.createDataFrame([(1.0, "x")], "trip_distance double, store_and_fwd_flag string")
    text = conform(frame, BRONZE)._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in text.split("trip_distance")[0]


def test_ingest_one_month_keeps_native_types_and_other_months(spark, base):
    raw = vendor(spark, "bigint", 7)
    for name in ("yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-02.parquet", "trips.parquet"):
        raw.write.parquet(f"{base}/raw/{name}")
        ingest_bronze(spark, f"{base}/raw/{name}", base)
    assert spark.read.parquet(f"{base}/{DATASET}/year=2023/month=1").dtypes == raw.dtypes
    ingest_bronze(spark, f"{base}/raw/yellow_tripdata_2023-01.parquet", base)
    bronze = read_bronze(spark, base)
    assert dict(bronze.dtypes)["year"] == "int"
    assert rows(bronze.select("VendorID", "year", "month")) == [
        (7.0, 2023, 1),
        (7.0, 2023, 2),
        (7.0, None, None),
    ]


def test_ingest_all_months_over_two_schemas(spark, base):
    vendor(spark, "bigint", 1).write.parquet(f"{base}/raw/yellow_tripdata_2022-12.parquet")
    vendor(spark, "double", 2.0).write.parquet(f"{base}/raw/yellow_tripdata_2023-01.parquet")
    vendor(spark, "double", 3.0).write.parquet(f"{base}/raw/yellow_tripdata_latest.parquet")
    vendor(spark, "double", 4.0).write.parquet(f"{base}/raw/green_tripdata_2023-01.parquet")
    write_month(vendor(spark, "double", 9.0), f"{base}/bronze/{DATASET}", 2021, 6)
    inputs = ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")
    assert [path.rsplit("/", 1)[-1] for path in inputs] == [
        "yellow_tripdata_2022-12.parquet",
        "yellow_tripdata_2023-01.parquet",
        "yellow_tripdata_latest.parquet",
    ]
    assert rows(read_bronze(spark, f"{base}/bronze").select("VendorID", "year", "month")) == [
        (1.0, 2022, 12),
        (2.0, 2023, 1),
        (3.0, None, None),
        (9.0, 2021, 6),
    ]


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_names_above_the_inputs_do_not_count(spark, base, scheme):
    raw = f"{base}/yellow_tripdata_2019-09 old+/raw"
    for month, kind in ((1, "bigint"), (2, "double")):
        name = f"yellow_tripdata_2023-{month:02d}.parquet"
        vendor(spark, kind, month if kind == "bigint" else 2.0).write.parquet(f"{raw}/{name}")
    inputs = ingest_bronze_months(spark, scheme + raw, f"{base}/bronze")
    assert inputs == [f"{scheme}{raw}/yellow_tripdata_2023-{m:02d}.parquet" for m in (1, 2)]
    assert rows(read_bronze(spark, f"{base}/bronze").select("VendorID", "year", "month")) == [
        (1.0, 2023, 1),
        (2.0, 2023, 2),
    ]


@pytest.mark.parametrize(
    ("base_path", "path"),
    [
        ("s3a://bucket", "s3a://bucket/a/b.parquet"),
        ("s3a://bucket/x/", "s3a://bucket/x/a/b.parquet"),
        ("hdfs:///x", "hdfs://node:8020/x/a/b.parquet"),
        ("/x", "file:/x/a/b.parquet"),
        ("/x.y(z", "file:/x.y(z/a/b.parquet"),
    ],
)
def test_path_below_a_base(spark, base_path, path):
    found = spark.range(1).select(below(base_path, F.lit(path))).first()[0]
    assert found == "a/b.parquet"


def test_a_folder_without_inputs_is_an_error(spark, base):
    vendor(spark, "bigint", 1).write.parquet(f"{base}/raw/green_tripdata_2023-01.parquet")
    with pytest.raises(FileNotFoundError):
        ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")


def test_two_inputs_of_one_month_are_refused(spark, base):
    for name in ("yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-01_v2.parquet"):
        vendor(spark, "bigint", 1).write.parquet(f"{base}/raw/{name}")
    with pytest.raises(ValueError, match="same month"):
        ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")


def test_plain_files_are_inputs_too(spark, base, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "raw").mkdir()
    pq.write_table(
        pa.table({"VendorID": [1, 2]}), f"{base}/raw/yellow_tripdata_2023-04.parquet"
    )
    assert len(raw_inputs(spark, f"{base}/raw")) == 1
    ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")
    assert rows(read_bronze(spark, f"{base}/bronze").select("VendorID", "year", "month")) == [
        (1.0, 2023, 4),
        (2.0, 2023, 4),
    ]


def test_overwrite_replaces_only_present_months(spark, base):
    path = f"{base}/{DATASET}"
    for year, month, tip in ((2023, 1, 1.0), (2023, 2, 2.0), (None, None, 3.0)):
        one = trips_frame(spark, [(None, 1.0, 1.0, tip)])
        write_months(by_file_month(one, year, month), path, replace="present")
    late = trips_frame(spark, [(None, 1.0, 1.0, 9.0)])
    write_months(by_file_month(late, 2023, 2), path, replace="present")
    assert rows(read_bronze(spark, base).select("tip_amount", "year", "month")) == [
        (1.0, 2023, 1),
        (3.0, None, None),
        (9.0, 2023, 2),
    ]


def test_partition_columns_live_in_the_path_only(spark, base):
    write_months(by_file_month(trips_frame(spark, [(None, 1.0, 1.0, 1.0)]), 2023, 2), base, replace="all")
    stored = spark.read.parquet(parquet_files(base)[0])
    assert not {"year", "month"} & set(stored.columns)


def test_layout_of_older_lakes(spark, base):
    inside = by_file_month(vendor(spark, "bigint", 1), 1999, 9)
    inside.write.parquet(f"{base}/{DATASET}/year=2023/month=1")
    vendor(spark, "bigint", 2).write.parquet(f"{base}/{DATASET}/year=None/month=None")
    assert rows(read_bronze(spark, base).select("VendorID", "year", "month")) == [
        (1.0, 2023, 1),
        (2.0, None, None),
    ]


def test_corrupt_files_stop_the_read_unless_skipped(spark, base):
    write_month(vendor(spark, "double", 1.0).coalesce(1), f"{base}/{DATASET}", 2023, 1)
    broken = f"{base}/{DATASET}/year=2023/month=1/broken file+1.parquet"
    with open(broken, "wb") as file:
        file.write(b"PAR1 this is not a parquet file PAR1")
    with pytest.raises(Exception):
        read_bronze(spark, base).count()
    assert read_bronze(spark, base, skip_corrupt=True).count() == 1
    assert [r.path for r in skipped_files(spark, base).collect()] == [f"file:{broken}"]


def test_old_timestamp_encoding_reads_the_same(spark, base, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    leaf = tmp_path / DATASET / "year=2023" / "month=1"
    leaf.mkdir(parents=True)
    times = pa.array([when("1890-01-01T00:00:00"), when("2023-01-05T10:00:00")], pa.timestamp("us"))
    table = pa.table({"tpep_pickup_datetime": times})
    pq.write_table(table, leaf / "old.parquet", use_deprecated_int96_timestamps=True)
    pq.write_table(table, leaf / "new.parquet")
    found = sorted(r[0] for r in read_bronze(spark, base).select("tpep_pickup_datetime").collect())
    assert found == [when("1890-01-01T00:00:00")] * 2 + [when("2023-01-05T10:00:00")] * 2


def test_types_that_differ_within_one_raw_month_lose_no_row(spark, base):
    raw = f"{base}/raw/yellow_tripdata_2023-01.parquet"
    for kind, value in (("int", 1), ("bigint", 2), ("double", 3.0)):
        vendor(spark, kind, value).coalesce(1).write.mode("append").parquet(raw)
    vendor(spark, "int", 9).write.parquet(f"{base}/raw/yellow_tripdata_2023-02.parquet")
    spark.createDataFrame([(7.5,)], "trip_distance double").write.parquet(
        f"{base}/raw/yellow_tripdata_2023-03.parquet"
    )
    ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")
    expected = [(1.0, 2023, 1), (2.0, 2023, 1), (3.0, 2023, 1), (9.0, 2023, 2), (None, 2023, 3)]
    bronze = read_bronze(spark, f"{base}/bronze").select("VendorID", "year", "month")
    assert rows(bronze) == expected
    ingest_bronze(spark, raw, f"{base}/single")
    assert rows(read_bronze(spark, f"{base}/single").select("VendorID")) == [(1.0,), (2.0,), (3.0,)]


def test_files_without_a_suffix_are_read(spark, base):
    import os

    for root in (f"{base}/raw/yellow_tripdata_2023-01.parquet", f"{base}/{DATASET}/year=2023/month=2"):
        vendor(spark, "bigint", 1).coalesce(1).write.parquet(root)
        vendor(spark, "int", 2).coalesce(1).write.mode("append").parquet(root)
        for i, path in enumerate(parquet_files(root)):
            os.rename(path, f"{root}/part-{i:05d}")
    ingest_bronze_months(spark, f"{base}/raw", base)
    assert rows(read_bronze(spark, base).select("VendorID", "month")) == [
        (1.0, 1),
        (1.0, 2),
        (2.0, 1),
        (2.0, 2),
    ]


def test_months_of_one_schema_are_found_in_few_jobs(spark, base):
    frame = vendor(spark, "bigint", 1).crossJoin(spark.range(80).select(F.col("id").alias("n")))
    months = {"year": (F.col("n") / 12 + 2000).cast("int"), "month": (F.col("n") % 12 + 1).cast("int")}
    write_months(frame.withColumns(months).drop("n"), f"{base}/{DATASET}", replace="all")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("schemas", "looking at footers")
    bronze = read_bronze(spark, base)
    jobs = len(tracker.getJobIdsForGroup("schemas"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3 and bronze.count() == 80


def test_bulk_ingest_parses_no_names_per_row(spark, base, monkeypatch):
    """Months are literals: what is written has no expression over paths."""
    from farelake.plans import jobs

    vendor(spark, "bigint", 1).write.parquet(f"{base}/raw/yellow_tripdata_2023-01.parquet")
    plans, write = [], jobs.write_month
    monkeypatch.setattr(
        jobs,
        "write_month",
        lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, *a),
    )
    ingest_bronze_months(spark, f"{base}/raw", f"{base}/bronze")
    assert len(plans) == 1 and not any(word in plans[0] for word in ("regexp_", "url_decode"))
