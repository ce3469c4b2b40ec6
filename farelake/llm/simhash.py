"""SimHash near-dedup by popcounts of fingerprint segments.

A fingerprint of 64 bits is cut into ``SEGMENTS`` segments; the numbers of one
bits in them are a point. A differing bit moves one coordinate by one at most, so
the Manhattan distance of two points is a lower bound of the number of differing
bits. Points within distance 2 have a grid cell within distance 1 of both: every
fingerprint is put into its own cell and the cells next to it, fingerprints are
joined within cells, and the bits compared. No pair is lost, and a cell holds only
points that could be pairs.

Only distinct fingerprints are joined, so thousands of copies are one row there.

Texts without words, null texts among them, have fingerprint zero and are linked
like any other. Rows of one id and text are one document. Null ids are never the
smallest id of a group that has another. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import KEY, key_of, materialize, packed, per_text, unpacked
from farelake.llm.components import components

SEGMENTS = 16
DISTANCE = 2
_WIDTH = 64 // SEGMENTS
_SEED = 42


def _fingerprinter() -> Callable[[str | None], tuple]:
    digest = xxhash.xxh64_intdigest

    def fingerprint(text: str | None) -> tuple:
        words = (text or "").encode().lower().split()
        if not words:
            return (0,)
        if len(words) < 3:
            shingles = [b" ".join(words)]
        else:
            shingles = map(b" ".join, zip(words, words[1:], words[2:]))
        digests = np.array([digest(s, _SEED) for s in shingles], np.uint64)
        ones = np.zeros(64, np.int64)
        for part in range(0, len(digests), 4096):
            block = digests[part : part + 4096].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits = np.packbits(ones * 2 > len(digests), bitorder="little")
        return (int(bits.view(np.int64)[0]),)

    return fingerprint


def fingerprint(text: Column) -> Column:
    """SimHash of the whole text over three-word shingles, as a bigint."""
    return per_text("fp long", _fingerprinter)(text).getField("fp")


def _cells(fp: Column) -> Column:
    """The cells a fingerprint is put into: packed counts, and the step that led there."""
    mask, digit = (1 << _WIDTH) - 1, _WIDTH.bit_length()
    counts = [
        F.bit_count(F.shiftrightunsigned(fp, _WIDTH * i).bitwiseAND(F.lit(mask)))
        for i in range(SEGMENTS)
    ]
    own = sum((c.cast("bigint") * F.lit(1 << digit * i) for i, c in enumerate(counts)), F.lit(0))
    cells = [F.struct(own.alias("cell"), F.lit(0).alias("step"))]
    for i, c in enumerate(counts):
        one = F.lit(1 << digit * i)
        up = F.struct((own + one).alias("cell"), F.lit(i + 1).alias("step"))
        down = F.struct((own - one).alias("cell"), F.lit(-i - 1).alias("step"))
        cells += [F.when(c < _WIDTH, up), F.when(c > 0, down)]
    return F.array_compact(F.array(*cells))


def links(fps: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (column ``fp``) that differ in 1 or 2 bits."""
    cells = fps.select("fp", F.explode(_cells(F.col("fp"))).alias("c")).select("fp", "c.*")
    left = cells.select("cell", F.col("fp").alias("a"), F.col("step").alias("step_a"))
    right = cells.select("cell", F.col("fp").alias("b"), F.col("step").alias("step_b"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # Two that moved by the same step have equal counts and met in their own cell.
    moved_apart = (F.col("step_a") != F.col("step_b")) | (F.col("step_a") == 0)
    # Spark sizes what comes out of an explode like what goes in, some 30 times too low.
    met = left.join(right.hint("merge"), "cell").where((F.col("a") < F.col("b")) & moved_apart)
    return met.where(differing <= DISTANCE).select("a", "b").distinct()


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: :data:`KEY`, ``id``, ``fp``, ``class`` and ``component_id``.

    ``class`` is the smallest fingerprint of the group, ``component_id`` its
    smallest id.
    """
    rows = docs.select(
        *key_of(id_col, text_col),
        F.col(id_col).cast("bigint").alias("id"),
        fingerprint(F.col(text_col)).alias("fp"),
    )
    rows = materialize(spark, rows, "fingerprints")
    distinct = materialize(
        spark, rows.groupBy("fp").agg(F.min("id").alias("least_id")), "fingerprints-distinct"
    )
    # Few bytes become many cells, so they are dealt out by number, not by bytes.
    spread = distinct.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "fp")
    roots = components(spark, links(spread))
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    classes = classes.select("fp", "least_id", F.coalesce("root", "fp").alias("class"))
    smallest = classes.groupBy("class").agg(F.min("least_id").alias("component_id"))
    named = classes.join(smallest, "class").select("fp", "class", "component_id")
    named = materialize(spark, named, "fingerprint-classes")
    return rows.join(named, "fp")


def one_of_each(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs``, one of each group: that of the smallest id."""
    found = near_duplicates(spark, docs, id_col, text_col)
    place = F.struct("k_null", "k_id", "k_text")
    kept = found.groupBy("class").agg(F.min(place).alias("k")).select("k.*")
    kept = materialize(spark, kept, "near-dedup-kept")
    rows = packed(docs, id_col, text_col).join(kept.hint("merge"), KEY).dropDuplicates(KEY)
    return unpacked(rows, docs.columns)
