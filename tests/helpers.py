"""Small literal frames and plan texts."""

from __future__ import annotations

import glob
from datetime import datetime

from pyspark.sql import functions as F

from farelake.operators import conform
from farelake.schemas import BRONZE


def when(text: str) -> datetime:
    return datetime.fromisoformat(text)


def trips_frame(spark, rows):
    """Trips under the Bronze contract from (pickup, distance, fare, tip) tuples."""
    rows = [(when(p) if p else None, d, f, t) for p, d, f, t in rows]
    schema = (
        "tpep_pickup_datetime timestamp, trip_distance double, fare_amount double, tip_amount double"
    )
    return conform(spark.createDataFrame(rows, schema), BRONZE)


def by_file_month(df, year, month):
    return df.withColumns({"year": F.lit(year).cast("int"), "month": F.lit(month).cast("int")})


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def parquet_files(path: str) -> list[str]:
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
