"""Document fingerprints by context-triggered piecewise hashing.

A hash rolled over the last ``ROLLED`` bytes decides where a chunk of the text
ends: where its lowest bits are all ones. Boundaries so depend on nearby bytes only
and come back after an edit. Every chunk gives one letter of the signature. The
block size is the smallest power of two that leads one to expect at most ``CHUNKS``
boundaries in the whole text. It is halved while a text has fewer than ``LEAST_CHUNKS``, as one
that repeats itself may, and then doubled while it has more than ``MOST_CHUNKS``. A second signature is made at twice the size. A
fingerprint is ``block:signature:signature at twice the block``.

Two fingerprints are compared where their block sizes agree or one is twice the
other: likeness is one less the edit distance of the two signatures divided by the
longer length. Other block sizes give 0, two empty texts 1.

Null texts are empty texts. Texts of any length are read whole, and texts of a few
letters have one letter per byte. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import per_text

CHUNKS = 64
LEAST_CHUNKS = 31
MOST_CHUNKS = 256
ROLLED = 7
#: Ranges of ids for each task; several even out what a task gets.
RANGES = 4
#: More ranges than this make no difference but a longer plan.
MOST_RANGES = 10_000
_LETTERS = np.frombuffer(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8
)


def signature(text: str) -> str:
    """The fingerprint of a whole text."""
    data = text.encode()
    if not data:
        return "1::"
    values = np.frombuffer(data, np.uint8).astype(np.uint32)
    rolled, factor = values.copy(), 1
    for back in range(1, ROLLED):
        factor = factor * 0x01000193 & 0xFFFFFFFF
        rolled[back:] += values[:-back] * np.uint32(factor)
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x85EBCA6B)
    rolled ^= rolled >> np.uint32(13)
    rolled[-1] = 0  # what follows the last boundary is a chunk in any case
    block = 1
    while block * CHUNKS < len(data):
        block *= 2

    def boundaries(size: int) -> np.ndarray:
        if size == 1:
            return np.arange(1, len(data))
        return np.flatnonzero((rolled & np.uint32(size - 1)) == size - 1) + 1

    def at(size: int) -> np.ndarray:
        return ends[(rolled[ends - 1] & np.uint32(size - 1)) == size - 1]

    ends = boundaries(block)
    while block > 1 and len(ends) < LEAST_CHUNKS:
        block //= 2
        ends = boundaries(block)
    while len(ends) > MOST_CHUNKS:
        block *= 2
        ends = at(block)
    twice = at(2 * block)

    def letters(ends: np.ndarray) -> str:
        cuts = [0, *ends.tolist(), len(data)]
        found = [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        mixed = np.array(found, np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(26)
        return _LETTERS[mixed].tobytes().decode()

    return f"{block}:{letters(ends)}:{letters(twice)}"


def fingerprint(text: Column) -> Column:
    """Column function of :func:`signature`."""

    def factory() -> Callable[[str | None], tuple]:
        return lambda text: (signature(text or ""),)

    return per_text("fingerprint string", factory)(text).getField("fingerprint")


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1, in built-in functions."""
    left, right = F.split(a, ":"), F.split(b, ":")
    block_a, block_b = left[0].cast("bigint"), right[0].cast("bigint")

    def alike(x: Column, y: Column) -> Column:
        longer = F.greatest(F.length(x), F.length(y))
        return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(x, y) / longer)

    return (
        F.when(a == b, F.lit(1.0))
        .when((left[1] == "") | (right[1] == ""), F.lit(0.0))
        .when(
            block_a == block_b,
            F.greatest(alike(left[1], right[1]), alike(left[2], right[2])),
        )
        .when(block_a == 2 * block_b, alike(left[1], right[2]))
        .when(block_b == 2 * block_a, alike(left[2], right[1]))
        .otherwise(F.lit(0.0))
    )


def next_to_each_other(spark: SparkSession, docs: DataFrame, parts: int) -> DataFrame:
    """Documents (``id``, ``text``) dealt out to ``parts`` tasks by ranges of the id, in order.

    Each range ends with a copy of the first row of the next range (``own`` is
    false), after the last range that of the first, so whoever reads a range knows
    every row's successor. Texts are moved once. Rows of one id are ordered by
    text, and never split.
    """
    known = docs.where("id IS NOT NULL")
    ranges = min(RANGES * parts, MOST_RANGES)
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    accuracy = max(10_000, 50 * ranges)
    bounds = known.agg(F.percentile_approx("id", shares, accuracy)).first()[0]
    bounds = sorted(set(bounds or []))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(bounds, np.int64), ids.to_numpy(np.int64)))

    part = F.when(F.col("id").isNull(), F.lit(0)).otherwise(
        range_of(F.coalesce("id", F.lit(0)))
    )
    placed = docs.withColumn("part", part)
    order = F.struct(F.col("id").isNotNull().alias("known"), "id")
    firsts = placed.groupBy("part").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = sorted(firsts.collect(), key=lambda row: row["part"])  # one row per range
    if not firsts:
        return placed.withColumn("own", F.lit(True))
    heads = [(row["first"]["id"], firsts[i - 1]["part"]) for i, row in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "head bigint, before int")
    # As many rows as ranges, so it may be broadcast.
    copies = docs.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head")))
    copies = copies.groupBy("before", "id").agg(F.min("text").alias("text"))
    copies = copies.select("id", "text", F.col("before").alias("part"), F.lit(False).alias("own"))
    every = placed.withColumn("own", F.lit(True)).unionByName(copies)
    return every.repartition(parts, "part").sortWithinPartitions(
        "part", F.desc("own"), F.asc_nulls_first("id"), F.asc_nulls_first("text")
    )


def _tail_replaced(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def edited(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Fingerprints of every text, of the text with its last quarter replaced by the
    start of the next document's, and of that next document."""
    plain = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    rows = next_to_each_other(spark, plain, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out = []
            columns = [batch.column(name).to_pylist() for name in ("part", "id", "text", "own")]
            for part, id_, text, own in zip(*columns):
                own_sign = signature(text)
                if held is not None and held[0] == part:
                    _, before, old, old_sign = held
                    made = _tail_replaced(old, text)
                    digest = hashlib.sha256(made.encode()).hexdigest()
                    out.append((before, len(old), digest, old_sign, signature(made), own_sign))
                held = (part, id_, text, own_sign) if own else None
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), _TYPES)], _NAMES
                )

    return rows.mapInArrow(signed, _SIGNED)


_SIGNED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, next_fingerprint string"
)
_NAMES = [field.split()[0] for field in _SIGNED.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]


def edit_report(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: fingerprints and their likeness to the edited and the next text."""
    rows = edited(spark, docs, id_col, text_col)
    return rows.select(
        *_NAMES[:5],
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
