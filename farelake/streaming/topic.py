"""Trip records as JSON messages on a topic.

A topic is replayed from its first to its last offset in one batch, which then overwrites whole
months, so a month is complete only while the topic still retains all of its messages. Or it
is followed: each run takes the messages behind those the last one ended with.

A message has a key that names the record: its input and its place there. Publishing an input
again, whole or in part, repeats keys, and the last message of a key is the record.
A message without a key is named by its own place on the topic, so it's read once however often it
is looked at.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from farelake.functions.times import iso_seconds, parse_timestamp
from farelake.operators.clean import PICKUP
from farelake.schemas import PAYLOAD, contract

# Client time-outs and waits in milliseconds, and the default topic.
CLIENT_OPTIONS = {
    "kafka.request.timeout.ms": "60000",
    "kafka.session.timeout.ms": "30000",
    "kafka.heartbeat.interval.ms": "10000",
    "kafka.metadata.max.age.ms": "300000",
    "kafka.reconnect.backoff.ms": "1000",
    "kafka.reconnect.backoff.max.ms": "10000",
    "kafka.retry.backoff.ms": "3000",
}
# Time-outs and waits of the client that writes.
PRODUCER_OPTIONS = {
    "kafka.request.timeout.ms": "60000",
    "kafka.max.block.ms": "180000",
    "kafka.connections.max.idle.ms": "300000",
}
DEFAULT_BOOTSTRAP = "kafka:9092"
DEFAULT_TOPIC = "trips_raw"

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)

#: What names and orders a message, kept beside the record it carries.
MESSAGE = contract("message_key binary, message_time timestamp, message_offset bigint")


class Topic(Protocol):
    """Something messages are written to and read from."""

    @property
    def whole(self) -> bool:
        """Whether a read gives all messages the topic holds."""

    def read(self, spark: SparkSession) -> DataFrame:
        """All messages with their envelope."""

    def follow(self, spark: SparkSession) -> DataFrame:
        """The messages as a stream, from the first the topic holds."""

    def write(self, messages: DataFrame) -> None:
        """Add messages held in a ``value`` column, named by ``key`` where there is one."""


@dataclass(frozen=True)
class KafkaTopic:
    """A Kafka topic, read without committing offsets of a consumer group.

    All partitions are read, or the first ``num_partitions`` by explicit assignment
    where that is given. Messages that are gone before they are read stop the job. Only a read of
    all partitions from first to last offset that would notice lost messages is ``whole``.
    A partition is one task unless ``min_tasks`` asks for more; partitions are
    then split by offsets, so one that holds most messages is not one task.
    """

    bootstrap: str = DEFAULT_BOOTSTRAP
    topic: str = DEFAULT_TOPIC
    num_partitions: int | None = None
    starting_offsets: str = "earliest"
    ending_offsets: str = "latest"
    fail_on_data_loss: bool = True
    min_tasks: int | None = None

    @property
    def whole(self) -> bool:
        return (
            self.starting_offsets == "earliest"
            and self.ending_offsets == "latest"
            and self.num_partitions is None
            and self.fail_on_data_loss
        )

    def read_options(self) -> dict[str, str]:
        """Options of the bounded read."""
        split = {"minPartitions": str(self.min_tasks)} if self.min_tasks else {}
        if self.num_partitions is None:
            partitions = {"subscribe": self.topic}
        else:
            partitions = {"assign": json.dumps({self.topic: list(range(self.num_partitions))})}
        return {
            "kafka.bootstrap.servers": self.bootstrap,
            **partitions,
            "startingOffsets": self.starting_offsets,
            "endingOffsets": self.ending_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
            **split,
            **CLIENT_OPTIONS,
        }

    def write_options(self) -> dict[str, str]:
        """Options of the write; all messages of a key go to one partition."""
        return {
            "kafka.bootstrap.servers": self.bootstrap,
            "topic": self.topic,
            **PRODUCER_OPTIONS,
        }

    def _named(self, envelope: DataFrame) -> DataFrame:
        place = F.concat_ws("#", "topic", "partition", "offset").cast("binary")
        return envelope.withColumn("key", F.coalesce("key", place))

    def read(self, spark: SparkSession) -> DataFrame:
        return self._named(spark.read.format("kafka").options(**self.read_options()).load())

    def follow(self, spark: SparkSession) -> DataFrame:
        options = {k: v for k, v in self.read_options().items() if k != "endingOffsets"}
        return self._named(spark.readStream.format("kafka").options(**options).load())

    def write(self, messages: DataFrame) -> None:
        columns = [name for name in ("key", "value") if name in messages.columns]
        messages.select(*columns).write.format("kafka").options(**self.write_options()).save()


@dataclass(frozen=True)
class FileTopic:
    """Messages as Parquet files, for use without a broker."""

    path: str
    whole: bool = True

    _STORED = "key binary, value binary, timestamp timestamp"

    def write(self, messages: DataFrame) -> None:
        key = F.col("key") if "key" in messages.columns else F.lit(None)
        messages.select(
            key.cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.current_timestamp().alias("timestamp"),
        ).write.mode("append").option("compression", "zstd").parquet(self.path)

    def _named(self, stored: DataFrame) -> DataFrame:
        row = F.col("_metadata.row_index")
        place = F.concat_ws("#", "_metadata.file_name", row).cast("binary")
        return stored.select(
            F.coalesce("key", place).alias("key"), "value", "timestamp", row.alias("offset")
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return self._named(spark.read.schema(self._STORED).parquet(self.path))

    def follow(self, spark: SparkSession) -> DataFrame:
        return self._named(spark.readStream.schema(self._STORED).parquet(self.path))


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON object in ``value``; a column that is its ``key`` stands apart.

    Columns named after a datetime or timestamp take the wire format, other
    timestamps their plain text. Null fields are left out of the object.
    """
    fields = []
    for field in df.schema:
        if field.name == key:
            continue
        column = F.col(f"`{field.name}`")
        if "datetime" in field.name or "timestamp" in field.name:
            column = iso_seconds(column)
        elif isinstance(field.dataType, _TIMESTAMPS):
            column = column.cast("string")
        fields.append(column.alias(field.name))
    value = F.to_json(F.struct(*fields)).alias("value")
    return df.select(F.col(key).cast("binary").alias("key"), value) if key else df.select(value)


def decode(
    envelope: DataFrame, schema: T.StructType = PAYLOAD, keep: Sequence[str] = ()
) -> DataFrame:
    """Fields of the JSON object in ``value``, after the ``keep`` columns.

    Fields outside the schema are dropped, missing ones are null, and text that
    is not JSON gives a row of nulls. A bare ``NaN`` is how some producers write
    a missing number, so it is read as null.
    """
    parsed = envelope.select(
        *keep, F.from_json(F.col("value").cast("string"), schema).alias("record")
    )
    fields = []
    for field in schema:
        column = F.col(f"record.`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.when(~F.isnan(column), column)
        fields.append(column.alias(field.name))
    return parsed.select(*keep, *fields)


def decode_trips(envelope: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trip records from messages, with the ``year`` and ``month`` of their pickup."""
    return _dated(_timed(decode(envelope, keep=keep)))


def _timed(records: DataFrame) -> DataFrame:
    times = [name for name in PAYLOAD.names if "datetime" in name]
    return records.withColumns({name: parse_timestamp(F.col(name)) for name in times})


def _dated(records: DataFrame) -> DataFrame:
    return records.withColumns({"year": F.year(PICKUP), "month": F.month(PICKUP)})


def trip_messages(envelope: DataFrame) -> DataFrame:
    """Trip records after the columns of :data:`MESSAGE`, the last of each key.

    What the envelope lacks is null; messages without a key are all kept. They are parsed
    before the last of each key is found: as records they are little more than half as large
    in the exchange that takes.
    """
    columns = zip(("key", "timestamp", "offset"), MESSAGE)
    named = [
        (F.col(name) if name in envelope.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for name, f in columns
    ]
    records = _timed(decode(envelope.select(*named, "value"), keep=MESSAGE.names))
    return _dated(last_of_each_key(records) if "key" in envelope.columns else records)


def last_of_each_key(records: DataFrame) -> DataFrame:
    """The record of each ``message_key`` with the latest time, then the greatest offset.

    A key occurs as often as its record was published, so no group is large. Keys of an
    input begin alike, so rows are sorted by a digest first, which tells nearly all apart. It is
    made after the exchange, by the key alone, so it is not written there. The last is
    the one that none lags behind: a rank would be cut in each task before the exchange, which
    sorts all rows once more and drops next to none.
    """
    key, time, offset = (F.col(name) for name in MESSAGE.names)
    latest = Window.partitionBy(F.xxhash64(key), key).orderBy(
        time.desc_nulls_last(), offset.desc_nulls_last()
    )
    keyed = records.where(key.isNotNull()).repartition(key)
    keyed = keyed.withColumn("later", F.lag(F.lit(1)).over(latest))
    last = keyed.where("later IS NULL").drop("later")
    return last.unionByName(records.where(key.isNull()))


def message_key(input_path: str, path: Column, row: Column) -> Column:
    """Name of a record: its input, its file there, and its place in the file."""
    name = input_path.rstrip("/").rsplit("/", 1)[-1]
    inside = F.substring_index(path, f"/{name}", -1)
    inside = F.when(inside.startswith("/"), F.substring(inside, 2, 1 << 20)).otherwise(inside)
    return F.concat_ws("#", F.lit(name), inside, row)


def peek(envelope: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages by partition and offset."""
    return envelope.orderBy("partition", "offset").limit(n)
