"""Zone lookup CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelake.schemas import TAXI_ZONE_LOOKUP, ZONE_CSV


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup with the column names of its serving table.

    A location that is not a whole number stops the read; an empty one is a null,
    which no serving table takes as a key.
    """
    rows = (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .schema(ZONE_CSV)
        .csv(path)
    )
    return rows.toDF(*TAXI_ZONE_LOOKUP.names)
