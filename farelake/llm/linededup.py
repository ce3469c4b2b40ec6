"""Line dedup: later copies of repeated runs of lines are deleted.

Documents are sequences of lines (text between line feeds, compared exactly). A
run of consecutive lines with more than ``MORE_THAN_WORDS`` words that occurs
again later, in document order (id, then line), is deleted there; its first copy
stays. See :mod:`farelake.llm.runs` for the method. Shorter repeated lines, such as
headings or licence lines, stay unless they are part of such a run.

Null texts stay null and empty ones empty. A document of which nothing is left
keeps its row with an empty text. Null ids come first. Rows with the same id and
the same text are one document read twice and are cut alike. A document may lose
lines to a copy within itself. Extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import KEY, key_of, materialize, packed, unpacked
from farelake.llm.runs import all_runs, in_repeated_class, tight_runs

MORE_THAN_WORDS = 50

def _runs_of(text: str | None, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lines = (text or "").encode().split(b"\n")
    weights = np.fromiter((len(line.split()) for line in lines), np.int64, len(lines))
    if weights.sum() < least:
        return np.empty(0, int), np.empty(0, int), np.empty((0, 2), np.uint64)
    digests = b"".join(map(xxhash.xxh3_128_digest, lines))
    return tight_runs(np.frombuffer(digests, np.uint64).reshape(-1, 2), weights, least)


def repeated_lines(spark: SparkSession, docs: DataFrame, more_than: int) -> DataFrame:
    """For each document (:data:`KEY`) with deletions, ``spans``: starts and ends in turn."""
    least = more_than + 1
    keyed = docs.select(*key_of("id", "text"), "text")
    rows = all_runs(keyed, lambda row: _runs_of(row["text"], least), ["text"])
    rows = materialize(spark, rows, "line-runs")
    place = F.struct((~F.col("k_null")).alias("known"), "k_id", "k_text", "start")
    later = in_repeated_class(spark, rows, place).where(place > F.col("first"))

    @F.pandas_udf("array<int>")
    def union(spans: pd.Series) -> pd.Series:
        def merged(flat: np.ndarray) -> list[int]:
            out: list[int] = []
            for start, end in sorted(zip(flat[::2], flat[1::2])):
                if out and start <= out[-1]:
                    out[-1] = max(out[-1], end)
                else:
                    out += [start, end]
            return out

        return spans.map(merged)

    spans = later.groupBy(*KEY).agg(F.flatten(F.collect_list(F.array("start", "end"))).alias("s"))
    return spans.select(*KEY, union("s").alias("spans"))


def _cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    def cut(text: str | None, flat: np.ndarray | None) -> tuple:
        if text is None:
            return None, 0, 0
        lines = text.split("\n")
        if flat is None:
            return text, len(lines), 0
        kept, last = [], 0
        for start, end in zip(flat[::2], flat[1::2]):
            kept += lines[last:start]
            last = end
        kept += lines[last:]
        return "\n".join(kept), len(lines), len(lines) - len(kept)

    rows = [cut(text, flat) for text, flat in zip(texts, spans)]
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])


def line_dedup(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    more_than: int = MORE_THAN_WORDS,
) -> DataFrame:
    """``row`` (the whole input row) and ``cut``: the text kept, ``n_lines``, ``n_removed``."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spans = materialize(spark, repeated_lines(spark, plain, more_than), "line-spans")
    rows = packed(docs, id_col, text_col).join(spans.hint("merge"), KEY, "left")
    cut = F.pandas_udf(_cut, "text string, n_lines long, n_removed long")
    return rows.select("row", cut(F.col("row").getField(text_col), "spans").alias("cut"))


def without_repeated_lines(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines cut from the text."""
    cut = line_dedup(spark, docs, id_col, text_col)
    return unpacked(cut, docs.columns, **{text_col: F.col("cut").getField("text")})
