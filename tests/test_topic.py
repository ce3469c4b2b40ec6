"""Messages: options, codec, cap, ingest."""

from __future__ import annotations

import json

import pytest
from helpers import rows, trips_frame, when
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.plans import ingest_messages
from farelake.schemas import ENVELOPE, PAYLOAD
from farelake.sources import first_rows, read_bronze, read_raw
from farelake.streaming import KafkaTopic, decode, decode_trips, encode, peek


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").select(
        F.col("value").cast("binary").alias("value")
    )


def test_read_options_assign_partitions():
    options = KafkaTopic("broker:9092", "trips", num_partitions=3).read_options()
    assert json.loads(options["assign"]) == {"trips": [0, 1, 2]}
    assert options["startingOffsets"] == "earliest" and options["endingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "true" and "subscribe" not in options
    assert len([name for name in options if name.endswith(".ms")]) == 7
    assert "minPartitions" not in options
    assert KafkaTopic(min_tasks=64).read_options()["minPartitions"] == "64"
    assert KafkaTopic(fail_on_data_loss=False).read_options()["failOnDataLoss"] == "false"
    every = KafkaTopic("b:1", "t").read_options()
    assert every["subscribe"] == "t" and "assign" not in every


def test_write_options():
    options = KafkaTopic("b:1", "t").write_options()
    assert options["kafka.bootstrap.servers"] == "b:1" and options["topic"] == "t"
    assert options["kafka.max.block.ms"] == "180000" and len(options) == 5


def test_bad_json_and_null_values_give_nulls(spark):
    decoded = decode(messages(spark, ["{bad", None, "[]", '{"trip_distance": 2.5, "other": 1}']))
    assert decoded.columns == PAYLOAD.names
    assert sorted((r.trip_distance for r in decoded.collect()), key=repr) == [2.5, None, None, None]


def test_nan_is_a_missing_number(spark):
    decoded = decode_trips(
        messages(spark, ['{"trip_distance": NaN, "tpep_pickup_datetime": NaN, "fare_amount": 1}'])
    ).first()
    assert decoded.trip_distance is None and decoded.tpep_pickup_datetime is None
    assert decoded.fare_amount == 1.0 and decoded.year is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [("NaN", None), ("", None), ("soon", None), ("2023-01-01T00:32:10", "2023-01-01T00:32:10")],
)
def test_unreadable_datetimes_are_null(spark, text, expected):
    value = json.dumps({"tpep_pickup_datetime": text})
    decoded = decode_trips(messages(spark, [value])).first()
    assert decoded.tpep_pickup_datetime == (expected and when(expected))
    assert (decoded.year, decoded.month) == ((2023, 1) if expected else (None, None))


def test_encode_formats_by_column_name(spark):
    frame = spark.createDataFrame(
        [(when("2023-01-02T03:04:05.678"), "2023-05-06 07:08:09", "x", when("2023-01-02T03:04:05"), None, 1)],
        "pickup_datetime timestamp, event_timestamp string, bad_datetime string, seen timestamp, gone double, n int",
    )
    assert json.loads(encode(frame).first().value) == {
        "pickup_datetime": "2023-01-02T03:04:05",
        "event_timestamp": "2023-05-06T07:08:09",
        "seen": "2023-01-02 03:04:05",
        "n": 1,
    }


def test_round_trip(spark):
    trips = trips_frame(
        spark,
        [
            ("2023-01-31T23:59:59", 1.5, 10.25, 0.1),
            ("2023-02-01T00:00:00", None, -3.0, None),
            (None, 0.0, 1e-7, 2.0),
        ],
    )
    decoded = decode_trips(encode(trips))
    assert decoded.drop("year", "month").columns == PAYLOAD.names
    assert rows(decoded.drop("year", "month")) == rows(trips.select(*PAYLOAD.names))


def test_messages_replace_the_months_they_hold(spark, base):
    first = trips_frame(spark, [("2023-01-01T00:00:00", 1.0, 1.0, 1.0), ("2023-02-01T00:00:00", 2.0, 1.0, 1.0)])
    ingest_messages(encode(first), base)
    second = trips_frame(spark, [("2023-02-05T00:00:00", 3.0, 1.0, 1.0), (None, 4.0, 1.0, 1.0)])
    ingest_messages(encode(second), base)
    bronze = read_bronze(spark, base)
    assert rows(bronze.select("trip_distance", "year", "month")) == [
        (1.0, 2023, 1),
        (3.0, 2023, 2),
        (4.0, None, None),
    ]
    assert bronze.where("VendorID IS NOT NULL").isEmpty()


def test_peek_is_in_topic_order(spark):
    envelope = spark.createDataFrame(
        [(p, o) for p in (1, 0) for o in (3, 1, 2)], "partition int, offset long"
    )
    assert [tuple(r) for r in peek(envelope, 4).collect()] == [(0, 1), (0, 2), (0, 3), (1, 1)]


def test_envelope_contract():
    assert ENVELOPE.names == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
    assert ENVELOPE["value"].dataType == T.BinaryType()


@pytest.mark.parametrize("limit", [1, 5, 9, 10, 11, 27, 30, 31, 1000, None, 0])
def test_first_rows_follow_file_order(spark, base, limit):
    for start in (0, 10, 20):
        spark.range(start, start + 10, 1, 1).write.mode("append").parquet(f"{base}/{start:02d}.parquet")
    frame = read_raw(spark, *[f"{base}/{start:02d}.parquet" for start in (0, 10, 20)])
    expected = list(range(30))[: limit or None]
    assert sorted(r.id for r in first_rows(frame, limit).collect()) == expected
