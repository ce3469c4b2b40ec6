"""Timestamps in and out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the wire format of datetimes, without a zone.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp, null when it cannot be read (also under ANSI mode)."""
    return F.try_to_timestamp(text)


def iso_seconds(value: Column) -> Column:
    """Timestamp, or text holding one, in the wire format; null when unreadable."""
    return F.date_format(value.try_cast("timestamp"), ISO_SECONDS)
