"""Session settings and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "farelake", conf: dict[str, str] | None = None) -> SparkSession:
    """A session with a fixed time zone; everything else stays with Spark and AQE.

    The number of shuffle partitions is left alone: AQE coalesces small ones and
    splits large ones, which a constant cannot do for both a month and a decade.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path every executor can reach.

    It lies under ``spark.checkpoint.dir``, or where that is unset under the
    warehouse folder, which all executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/farelake-{name}-{uuid.uuid4().hex}"
