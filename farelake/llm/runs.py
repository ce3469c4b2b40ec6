"""Repeated runs of tokens: suffixes named by prefix doubling, compared over all sequences.

A sequence is the tokens of one document or page. Doubling gives every suffix a
rank for its first 1, 2, 4, ... tokens; two ranks name a prefix of any length.
Ranks are digests of 128 bits and not places in a sorted list, so a round needs
no exchange between tasks: equal prefixes have equal ranks wherever they lie.

A run counts if its tokens weigh ``least`` or more together. It is enough to look
at *tight* runs, those that fall below ``least`` without their last token, or
without their first. If a run [a, b) occurs twice, every tight run inside it does
too, and these cover it: a token with enough weight behind it inside the run is in
the tight run that starts there, one with enough before it in the tight run that
ends there, and one with neither in the tight run that starts last. So the classes
of equal tight runs are the intervals of the suffix array where the longest common
prefix reaches ``least``, and their union is that of all maximal repeated runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.typing import NDArray
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import KEY, materialize

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_C = np.uint64(0xFF51AFD7ED558CCD)
_SHIFT = np.uint64(32)


def _paired(left: NDArray, right: NDArray, extra: NDArray | int) -> NDArray:
    """Digest of two ranks side by side and a number; both lanes use both halves."""
    mixed = (left * _A) ^ ((right + _B) * _C + (right >> _SHIFT))
    mixed[:, 0] += mixed[:, 1] * _B
    mixed ^= mixed >> _SHIFT
    mixed *= _C
    mixed[:, 1] += mixed[:, 0]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _A
    return mixed + np.asarray(extra, np.uint64).reshape(-1, 1) * _B


def tight_runs(tokens: NDArray, weights: NDArray, least: int) -> tuple[NDArray, NDArray, NDArray]:
    """Starts, ends (exclusive) and names (n, 2) of the tight runs of one sequence.

    ``tokens`` are digests (n, 2) of unsigned 64 bits.
    """
    total = np.concatenate([[0], np.cumsum(weights)])
    n = len(weights)
    place = np.arange(n + 1)
    ends = np.searchsorted(total, total + least, "left")
    starts = np.searchsorted(total, total - least, "right") - 1
    runs = np.concatenate(
        [
            np.column_stack([place, ends])[ends <= n],
            np.column_stack([starts, place])[(starts >= 0) & (starts < place)],
        ]
    )
    runs = np.unique(runs, axis=0)
    start, end = runs[:, 0], runs[:, 1]
    names = np.empty((len(runs), 2), np.uint64)
    lengths = end - start
    level, ranks = 0, tokens
    while len(runs):
        now = (lengths >> level) == 1
        width = 1 << level
        at = np.flatnonzero(now)
        names[at] = _paired(ranks[start[at]], ranks[end[at] - width], lengths[at])
        if not (lengths >> level > 1).any():
            break
        ranks = _paired(ranks[:-width], ranks[width:], 1 << 40)
        level += 1
    return start, end, names


_RUNS = "k_id bigint, k_null boolean, k_text bigint, start int, end int, n1 bigint, n2 bigint"


def all_runs(
    rows: DataFrame,
    of: Callable[[dict], tuple],
    inputs: list[str],
    content: bool = False,
) -> DataFrame:
    """Tight runs of every row: :data:`KEY`, ``start``, ``end`` and the name ``n1``, ``n2``.

    ``of`` gives starts, ends and names from a row's ``inputs``; with ``content`` also a
    signed number of 64 bits, which becomes a column of that name.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [of(row) for row in batch.select(inputs).to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
            none = np.empty(0, np.int64)
            names = np.concatenate([x[2] for x in found] or [none.reshape(0, 2)])
            columns = [batch.column(name).take(pa.array(at)) for name in KEY]
            for i in (0, 1):
                part = np.concatenate([x[i] for x in found] or [none])
                columns.append(pa.array(part.astype(np.int32)))
            names = names.astype(np.uint64)
            columns += [pa.array(names[:, i].copy().view(np.int64)) for i in (0, 1)]
            made = [*KEY, "start", "end", "n1", "n2"]
            if content:
                columns.append(pa.array([x[3] for x in found], pa.int64()).take(pa.array(at)))
                made.append("content")
            yield pa.RecordBatch.from_arrays(columns, made)

    schema = _RUNS + ", content bigint" if content else _RUNS
    return rows.select(*KEY, *inputs).mapInArrow(runs, schema)


def in_repeated_class(spark: SparkSession, rows: DataFrame, place: Column) -> DataFrame:
    """Runs whose class has two different ``place`` values, with the ``first`` of them.

    Counts are made in part before the exchange. The classes are written, so that
    both sides of the join are dealt out anew and a class that holds a third of all
    runs can be split.
    """
    classes = (
        rows.groupBy("n1", "n2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") < F.col("last"))
        .drop("last")
    )
    return rows.join(materialize(spark, classes, "run-classes").hint("merge"), ["n1", "n2"])


def in_class_of_contents(spark: SparkSession, rows: DataFrame, least: int) -> DataFrame:
    """Runs whose class has ``least`` different values of ``content`` or more.

    Equal contents are made one before they are counted, by all three columns, so a
    class of very many runs is dealt out like any other.
    """
    classes = rows.select("n1", "n2", "content").distinct().groupBy("n1", "n2").count()
    classes = classes.where(F.col("count") >= least).select("n1", "n2")
    return rows.join(materialize(spark, classes, "run-classes").hint("merge"), ["n1", "n2"])
