"""Vector code compression: product quantisation with memoised grid cells.

Vectors become integers, floor(4096 * x), and are cut into equal consecutive parts. Each
part position has a codebook; a part is coded as the index of its nearest entry (squared
Euclidean distance, the lower index of equal ones). Entries start as the parts of the vectors
of the smallest ids and are replaced a stated number of times by the floor of the mean of
the parts nearest to them; an entry that no part chose stays.

*Memoised cells.* Space is cut into boxes of a power of two. The first part that falls into a box
finds which entries can be nearest anywhere in it: an entry whose least distance to the box
exceeds another's greatest is dominated and never nearest, nor tied, there. The rest are
remembered under the hash of the box, and only they are compared exactly, for this part and for
all later ones of the box. Entries that tie are never dominated, so results are those
of comparing every entry.

Codebooks are 16 rows or fewer, so they travel with the task. Sums are made within tasks first: what
a round exchanges and brings to the driver are sums and counts of entries, as many
whatever the number of vectors. All of it is whole numbers, so results do not
depend on how rows are dealt out.

Vectors that are null or hold nulls or non-finite components are dropped. All others must be of one
length, a multiple of the number of parts, and below 2**14 in every component; else the job
stops with an error that says so. Rows without an id are coded but never start an entry;
where no row has an id there are no entries, and codes and errors are null. Of several vectors with one id
the least starts an entry. Empty vectors are all alike: error 0. Repeated rows are
coded alike and count as often as they occur. With fewer ids than entries there are as many entries as ids. Null
labels are one label. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.typing import NDArray
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import materialize

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Distances of smaller integers are exact in 64 bits for parts of up to 512 components.
_LARGEST = 1 << 26
#: Boxes of one part that a task remembers. A bound of memory: beyond it they are found anew.
_MOST_BOXES = 1 << 14

#: Codebooks: entries of each part, (parts, entries, components).
Codebooks = NDArray


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id``, ``label`` and ``v``, the components as integers, of vectors that are kept."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(vector.isNotNull() & F.coalesce(finite, F.lit(False)))
    too_large = F.raise_error(F.lit(f"components must be below {_LARGEST // SCALE}")).cast("int")
    whole = F.transform(
        vector,
        lambda x: F.when(
            F.abs(x) < _LARGEST // SCALE, F.floor(x.cast("double") * SCALE).cast("int")
        ).otherwise(too_large),
    )
    return kept.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), whole.alias("v")
    )


_HASH = np.random.Generator(np.random.PCG64(13)).integers(1, 1 << 62, 4096, np.int64) * 2 + 1


def _distinct(boxes: NDArray) -> tuple[NDArray, NDArray]:
    """Different boxes, found by their hashes, and which of them each row is."""
    hashes = (boxes * np.resize(_HASH, boxes.shape[1])).sum(axis=1)
    _, first, at = np.unique(hashes, return_index=True, return_inverse=True)
    found = boxes[first]
    if not np.array_equal(found[at], boxes):  # two boxes with one hash
        found, at = np.unique(boxes, axis=0, return_inverse=True)
    return found, at.reshape(-1)


class _Cells:
    """The nearest entries of one part position."""

    def __init__(self, entries: NDArray) -> None:
        self.entries = entries
        self.known: dict[bytes, NDArray] = {}
        spread = entries.std(axis=0).mean() if entries.size else 0
        #: Boxes are about as wide as the entries are apart in one component.
        self.shift = max(0, int(np.log2(max(1, spread))))

    def _candidates(self, boxes: NDArray) -> NDArray:
        """For each box, which entries no other dominates."""
        low = (boxes << self.shift)[:, None, :]
        high = low + ((1 << self.shift) - 1)
        below, above = low - self.entries, self.entries - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def _remembered(self, boxes: NDArray) -> NDArray:
        keys = [box.tobytes() for box in boxes]
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > _MOST_BOXES:
            self.known.clear()
            new = range(len(keys))
        if len(new):
            found = self._candidates(boxes[new])
            self.known.update((keys[i], row) for i, row in zip(new, found))
        return np.array([self.known[key] for key in keys])

    def nearest(self, points: NDArray) -> tuple[NDArray, NDArray]:
        """Index of the nearest entry of each point, and its squared distance."""
        boxes, at = _distinct(points >> self.shift)
        open_to = self._remembered(boxes)[at]
        index = np.zeros(len(points), np.int64)
        error = np.full(len(points), np.iinfo(np.int64).max)
        for i, entry in enumerate(self.entries):
            rows = np.flatnonzero(open_to[:, i])
            distance = ((points[rows] - entry) ** 2).sum(axis=1)
            closer = distance < error[rows]
            index[rows[closer]] = i
            error[rows[closer]] = distance[closer]
        return index, error


def _points(batch: pa.RecordBatch, books: Codebooks) -> NDArray:
    """Vectors of a batch as (parts, rows, components)."""
    column = batch.column("v")
    parts, _, width = books.shape
    if not np.array_equal(np.diff(column.offsets.to_numpy()), np.full(len(column), parts * width)):
        raise ValueError(f"vectors must all have {parts * width} components")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, width).transpose(1, 0, 2)


def _sums(books: Codebooks):
    """Sums and counts of what each entry is nearest to, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [_Cells(entries) for entries in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for part, points in enumerate(_points(batch, books)):
                index, _ = cells[part].nearest(points)
                np.add.at(sums[part], index, points)
                counts[part] += np.bincount(index, minlength=books.shape[1])
        place = np.arange(sums.size)
        each = np.broadcast_to(counts[:, :, None], sums.shape).reshape(-1)
        used = each > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[used]) for x in (place, sums.reshape(-1), each)], ["place", "total", "n"]
        )

    return run


def _codes(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [_Cells(entries) for entries in books]
        for batch in batches:
            found = [cells[i].nearest(points) for i, points in enumerate(_points(batch, books))]
            codes = np.array([index for index, _ in found], np.uint8).T
            error = np.sum([error for _, error in found], axis=0, dtype=np.int64)
            text = [row.tobytes().hex() for row in np.ascontiguousarray(codes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error)],
                ["id", "label", "code", "error"],
            )

    return run


def _first(kept: DataFrame, entries: int) -> list[list[int]]:
    """Vectors of the smallest ids; ids that occur in many rows may take several looks."""
    found: dict[int, list[int]] = {}
    rows = kept.where("id IS NOT NULL").select("id", "v")
    while len(found) < entries:
        after = rows.where(F.col("id") > max(found)) if found else rows
        least = after.orderBy("id", "v").limit(entries - len(found)).collect()
        if not least:
            break
        for row in least:
            found.setdefault(row.id, row.v)
    return list(found.values())


def fit(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks | None:
    """Codebooks over all rows of :func:`integers`; None where no row has an id."""
    start = _first(kept, entries)
    if not start:
        return None
    width, rest = divmod(len(start[0]), parts)
    if rest or any(len(v) != len(start[0]) for v in start):
        raise ValueError(f"vectors must all have the same multiple of {parts} components")
    books = np.array(start, np.int64).reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        made = kept.select("v").mapInArrow(_sums(books), "place bigint, total bigint, n bigint")
        summed = made.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        flat = books.reshape(-1)
        for row in summed.collect():  # one row for each component of an entry
            flat[row.place] = row.total // row.n
        books = flat.reshape(books.shape)
    return books


def digest(books: Codebooks) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(
    spark: SparkSession,
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``id``, ``label``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of kept vectors."""
    kept = materialize(spark, integers(vectors, id_col, vector_col, label_col), "integers")
    books = fit(kept, parts, entries, rounds)
    label = kept.schema["label"].dataType.simpleString()
    if books is None:
        nothing = {"code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
        return kept.select(
            "id", "label", *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()]
        )
    coded = kept.mapInArrow(_codes(books), f"id bigint, label {label}, code string, error bigint")
    coded = materialize(spark, coded, "codes")
    # One row for each label, made in part before the exchange; a label that a third of all
    # rows have is split by the join.
    sums = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("same"))).drop("same")
    return joined.withColumn("codebooks_sha256", F.lit(digest(books)))
