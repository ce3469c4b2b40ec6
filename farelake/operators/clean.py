"""Bronze to Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PICKUP = "tpep_pickup_datetime"


def clean_trips(trips: DataFrame) -> DataFrame:
    """Trips with a distance and no negative fare, dated by their pickup.

    Null distances and fares go; NaN compares as larger than any number and
    stays. ``year`` and ``month`` come from the pickup, not from the file, so a
    trip without a pickup has none.
    """
    return (
        trips.where((F.col("trip_distance") > 0) & (F.col("fare_amount") >= 0))
        .withColumn("pickup_date", F.to_date(PICKUP))
        .withColumns({"year": F.year("pickup_date"), "month": F.month("pickup_date")})
    )
