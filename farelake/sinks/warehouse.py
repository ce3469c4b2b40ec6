"""Serving tables in a database or in Parquet directories."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.operators.conform import to_table
from farelake.operators.serving import latest_run
from farelake.schemas import LATEST_VIEWS, PRIMARY_KEYS, SERVING_TABLES
from farelake.sinks.files import exists


def check_keys(df: DataFrame, table: str) -> None:
    """Raise if rows meant for a table have null or repeated keys.

    One aggregate over the rows, before anything stored is touched.
    """
    keys = PRIMARY_KEYS.get(table)
    if not keys:
        return
    rows = df.groupBy(*keys).count()
    null = reduce(or_, [F.col(key).isNull() for key in keys])
    found = rows.agg(
        F.count_if(null).alias("null"), F.count_if(F.col("count") > 1).alias("repeated")
    ).first()
    if found["null"] or found["repeated"]:
        raise ValueError(
            f"{table}: {found['null']} null and {found['repeated']} repeated keys of "
            f"({', '.join(keys)}); the table was left as it is"
        )


def unrecorded(records: DataFrame, stored: DataFrame, table: str) -> DataFrame:
    """One record for each run that ``stored`` has none of.

    A job that is tried again, or a run that is evaluated twice, adds its record once.
    """
    once = records.dropDuplicates(["run_id"]).join(stored.select("run_id"), "run_id", "left_anti")
    return to_table(once, table)


class Warehouse(Protocol):
    """Where serving tables live."""

    def replace(self, df: DataFrame, table: str) -> None:
        """Make the rows of ``df`` the whole content of the table, if their keys are sound."""

    def append(self, df: DataFrame, table: str) -> None:
        """Add the rows of ``df`` to the table."""

    def record(self, df: DataFrame, table: str) -> None:
        """Add records of runs, but none of a run the table has a record of."""

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table under its contract."""


@dataclass(frozen=True)
class JdbcWarehouse:
    """Tables in a relational database.

    ``replace`` empties the table instead of dropping it, which keeps its
    primary key and indexes. Spark empties and fills in separate transactions:
    a reader may see the table empty in between, and a failed fill leaves it so
    until the job runs again.

    ``record`` looks up run ids first. Two jobs that record the same run at one moment are kept
    apart by the database alone: a unique key on ``run_id`` makes the second insert fail and
    leaves the first record.
    """

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    schema: str = "public"
    max_connections: int = 8

    def options(self, table: str) -> dict[str, str]:
        """Connection options for one table."""
        return {
            "url": self.url,
            "dbtable": f"{self.schema}.{table}",
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "numPartitions": str(self.max_connections),
        }

    def replace(self, df: DataFrame, table: str) -> None:
        check_keys(df, table)
        writer = to_table(df, table).write.format("jdbc").options(**self.options(table))
        writer.option("truncate", True).mode("overwrite").save()

    def append(self, df: DataFrame, table: str) -> None:
        to_table(df, table).write.format("jdbc").options(**self.options(table)).mode("append").save()

    def record(self, df: DataFrame, table: str) -> None:
        self.append(unrecorded(df, self.read(df.sparkSession, table), table), table)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return to_table(spark.read.format("jdbc").options(**self.options(table)).load(), table)


@dataclass(frozen=True)
class FileWarehouse:
    """The same tables as Parquet directories, for use without a database."""

    base: str

    def replace(self, df: DataFrame, table: str) -> None:
        check_keys(df, table)
        to_table(df, table).write.mode("overwrite").parquet(f"{self.base}/{table}")

    def append(self, df: DataFrame, table: str) -> None:
        to_table(df, table).write.mode("append").parquet(f"{self.base}/{table}")

    def record(self, df: DataFrame, table: str) -> None:
        if exists(df.sparkSession, f"{self.base}/{table}"):
            df = unrecorded(df, self.read(df.sparkSession, table), table)
        self.append(df, table)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.schema(SERVING_TABLES[table]).parquet(f"{self.base}/{table}")


def register_views(
    spark: SparkSession, warehouse: Warehouse, tables: Sequence[str] = tuple(SERVING_TABLES)
) -> None:
    """Serving tables as temporary views for SQL, with a view of the latest run of each kind."""
    for table in tables:
        stored = warehouse.read(spark, table)
        stored.createOrReplaceTempView(table)
        if table in LATEST_VIEWS:
            latest_run(stored).createOrReplaceTempView(LATEST_VIEWS[table])
