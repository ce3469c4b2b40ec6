"""Helpers shared by the operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.session import scratch_path

#: XXH64 seed and A-Z lowering are the same in every word rule of this package.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    It cuts the lineage: what follows survives lost executors without repeating
    the work, and a result is never computed twice.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def memo(name: str, build: Callable[[], Any]) -> Any:
    """A value built once per Python process and kept for its next tasks.

    Only the latest is kept, so what one operator remembers doesn't add to what
    the next one does.
    """
    kept = sys.modules.setdefault("farelake_llm_memo", types.ModuleType("farelake_llm_memo"))
    if getattr(kept, "name", None) != name:
        kept.name, kept.value = None, None
        kept.name, kept.value = name, build()
    return kept.value


def per_text(schema: str, factory: Callable[[], Callable[[str | None], tuple]]) -> Callable:
    """A column function over texts, run on Arrow batches.

    ``factory`` runs once per task and gives the function of one text; that
    returns one tuple in the order of ``schema``.
    """
    names = [field.split()[0] for field in schema.split(", ")]

    @F.pandas_udf(schema)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        function = factory()
        for texts in batches:
            yield pd.DataFrame([function(text) for text in texts], columns=names)

    return apply


#: Columns that name a document: its id, whether the id is null, a digest of its text.
KEY = ["k_id", "k_null", "k_text"]


def key_of(id_col: str, text_col: str) -> list[Column]:
    """The columns of :data:`KEY`.

    Rows of the same id and the same text are one document read twice. The digest
    only needs to tell apart the texts of one id.
    """
    number = F.col(id_col).cast("bigint")
    return [
        F.coalesce(number, F.lit(0)).alias("k_id"),
        number.isNull().alias("k_null"),
        F.xxhash64(F.col(text_col)).alias("k_text"),
    ]


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """:data:`KEY` and the whole row as ``row``, so that no column name can clash."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    return docs.select(*key_of(id_col, text_col), row)


def unpacked(docs: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row``, with some of them replaced."""
    return docs.select(
        *[changed.get(name, F.col("row").getField(name)).alias(name) for name in columns]
    )


def ascii_lower(text: str | Column) -> Column:
    """A-Z in lower case, all else as it is; null gives an empty text."""
    col = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def sampled(rows: DataFrame, key: Column, at_most: int) -> DataFrame:
    """About ``at_most`` rows, the same ones in every run; all rows if there are fewer.

    Rows are chosen by a digest of their key, so no task sees more than its own. Rows
    of one key are chosen or left together: make them one row afterwards.
    """
    total = rows.count()
    if total <= at_most:
        return rows
    kept = int(SLOTS * (at_most / total * 0.98))
    return rows.where(slot("sample", key) < kept)


#: Fine enough for a few thousand rows of any number.
SLOTS = 1 << 62


def slot(name: str, key: str | Column) -> Column:
    """A number below :data:`SLOTS` that depends on the key alone."""
    return F.pmod(F.xxhash64(F.lit(name), key), F.lit(SLOTS))
