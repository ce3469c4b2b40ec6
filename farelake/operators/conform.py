"""Bring a frame to a contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.schemas import SERVING_TABLES


def conform(df: DataFrame, contract: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of the contract, in its order and types, then the ``keep`` columns.

    Names match whatever their case. Missing columns become typed nulls, others
    are dropped, and values a type cannot hold become null. A column that has
    its type already is passed through bare, so filters on it reach the scan.
    """
    return df.select(*[fitted(df, want).alias(want.name) for want in contract], *keep)


def fitted(df: DataFrame, want: T.StructField) -> Column:
    """A column of the contract as ``df`` can give it."""
    have = next((f for f in df.schema if f.name.lower() == want.name.lower()), None)
    if have is None:
        return F.lit(None).cast(want.dataType)
    if have.dataType == want.dataType:
        return F.col(have.name)
    return F.col(have.name).try_cast(want.dataType)


def to_table(df: DataFrame, table: str) -> DataFrame:
    """Columns of a serving table in its order; types must fit or the plan fails."""
    return df.to(SERVING_TABLES[table])
