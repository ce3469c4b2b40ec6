"""Ranked lexical search: the highest-scoring documents of every item, by groups of masks.

A term is a maximal run of letters, digits and characters beyond ASCII, only A-Z lower-cased. A
term's weight is floor(1000 * ln((2N + 2) / (2df + 1))) and a document's score for an item the
sum of weight * ((10**9 * tf) div (1000 * tf + 8 * m)) over the item's terms that it
holds, where m = 10 + (90 * n * N) div L grows with its length n; N documents have terms, L
in all. See :func:`search` for what is returned.

*Presence masks.* A task takes some thousand documents at a time and makes one bitmap for each term: which of
them hold it. The bitmaps of an item's terms, read across, give each document its mask: which
of the item's terms it holds. Documents of the same mask are one group, and the sum of the greatest
contributions of the mask's terms bounds the score of all of them. Groups are
evaluated in the order of their bounds, and an item is finished as soon as the next bound is
below the score of the last of its best so far: no document left can displace one. Bounds
equal to that score are still evaluated, since ids decide ties. What a task has found bounds
its later documents, so most groups there are never evaluated.

Statistics cover all documents. One pass over the texts writes the terms of the items each document holds, with
their counts; all else reads that. Tasks hand on their best of each item, which
is all that is exchanged. Items are taken in parts of about ``item_bytes`` of text, so what is sent
to tasks is bounded whatever their number; each part is one pass over the documents.

Null and empty texts have no terms: such documents are never found, such items find none. Rows
are ranked each on their own, repeated ones too; among equal scores null ids come last. Items
of the same id and text are one item. Texts of any length are read whole, and no other column is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from numpy.typing import NDArray
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm.common import materialize

BEST = 10
#: Text of the items that one pass over the documents answers.
ITEM_BYTES = 1 << 20
#: Terms as a regular expression, for SQL.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_BLOCK_BYTES = 4 << 20
#: Documents whose bitmaps are made together, and the most bits of all of them.
_DOCUMENTS_TOGETHER = 4096
_MOST_BITS = 1 << 26
#: Documents evaluated before the bound is looked at again.
_EVALUATED_TOGETHER = 64


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, in order."""
    return (text or "").encode().translate(_KEPT).split()


def _held(vocabulary: dict[bytes, int]):
    """For each document its length in terms, and the numbers and counts of known terms."""

    def block(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        numbers = map(vocabulary.get, chain.from_iterable(texts), repeat(-1))
        found = np.fromiter(numbers, np.int64, lengths.sum())
        at = np.repeat(np.arange(len(texts)), lengths)
        known = found >= 0
        size = max(1, len(vocabulary))
        pairs, counts = np.unique(at[known] * size + found[known], return_counts=True)
        upto = np.searchsorted(pairs, np.arange(len(texts) + 1) * size).astype(np.int32)
        columns = [
            pa.array(ids, pa.int64()),
            pa.array(lengths),
            pa.ListArray.from_arrays(upto, pa.array((pairs % size).astype(np.int32))),
            pa.ListArray.from_arrays(upto, pa.array(counts.astype(np.int32))),
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        size = 0
        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                words = text.as_py()
                size += len(words or "")
                ids.append(id_)
                texts.append(terms(words))
                if size >= _BLOCK_BYTES:
                    yield block(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield block(ids, texts)

    return run


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _length_terms(lengths: NDArray, documents: int, total: int) -> NDArray:
    """m of documents of some lengths."""
    if 90 * documents * int(lengths.max(initial=0)) >= 1 << 63:
        lengths = lengths.astype(object)
    return (10 + (90 * documents * lengths) // max(1, total)).astype(np.int64)


class _Documents:
    """Some documents: what their terms contribute, and a bitmap of documents for each term."""

    def __init__(self, ids, lengths, upto, held, counts, weights, documents, total) -> None:
        self.ids, self.upto, self.held = ids, upto, held
        at = np.repeat(np.arange(len(ids)), np.diff(upto))
        m = _length_terms(lengths, documents, total)[at]
        counts = counts.astype(np.int64)
        self.scores = weights[held] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))
        self.greatest = np.zeros(len(weights), np.int64)
        np.maximum.at(self.greatest, held, self.scores)
        present = np.zeros((len(weights), len(ids)), bool)
        present[held, at] = True
        self.bitmaps = np.packbits(present, axis=1)

    def groups(self, item: NDArray) -> tuple[NDArray, NDArray]:
        """Masks of an item's terms that occur, with the documents of each.

        Returns the bound of each document's group, greatest first, and the documents
        in that order; those of one mask stand together.
        """
        bits = np.unpackbits(self.bitmaps[item], axis=1, count=len(self.ids))
        masks = np.packbits(bits, axis=0)
        width = -len(masks) % 8
        masks = np.vstack([masks, np.zeros((width, masks.shape[1]), np.uint8)]) if width else masks
        masks = np.ascontiguousarray(masks.T).view(np.uint64)
        order = np.lexsort(masks.T)
        masks = masks[order]
        new = np.ones(len(order), bool)
        new[1:] = (masks[1:] != masks[:-1]).any(axis=1)
        # Whole numbers below 2**53 are exact as doubles, and so are their sums here.
        bounds = self.greatest[item].astype(float) @ bits[:, order[new]]
        best = np.argsort(-bounds, kind="stable")
        sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
        starts = np.flatnonzero(new)[best]
        sizes = sizes[best]
        ends = np.cumsum(sizes)
        place = np.arange(len(order)) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)
        return np.repeat(bounds[best].astype(np.int64), sizes), order[place]

    def evaluate(self, at: NDArray, member: NDArray) -> NDArray:
        """Scores of some documents for the item whose terms ``member`` marks."""
        sizes = self.upto[at + 1] - self.upto[at]
        ends = np.cumsum(sizes)
        place = np.arange(sizes.sum()) + np.repeat(self.upto[at] - (ends - sizes), sizes)
        scores = np.where(member[self.held[place]], self.scores[place], 0)
        total = np.concatenate([[0], np.cumsum(scores)])
        return total[ends] - total[ends - sizes]


#: Sorts behind every id.
_NO_ID = np.iinfo(np.int64).max


def _ranked(items: list[NDArray], weights: NDArray, documents: int, total: int, best: int):
    """The best documents of a task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = max(64, min(_DOCUMENTS_TOGETHER, _MOST_BITS // max(1, len(weights))))
        empty = np.empty(0, np.int64)
        found = [(empty, empty, np.empty(0, bool)) for _ in items]
        least = np.zeros(len(items), np.int64)
        member = np.zeros(len(weights), bool)
        for batch in batches:
            for since in range(0, batch.num_rows, together):
                part = batch.slice(since, together)
                ids = part.column("id")
                docs = _Documents(
                    ids.fill_null(_NO_ID).to_numpy(),
                    part.column("n").to_numpy(),
                    (o := part.column("terms").offsets.to_numpy()) - o[0],
                    part.column("terms").flatten().to_numpy(),
                    part.column("counts").flatten().to_numpy(),
                    weights,
                    documents,
                    total,
                )
                unknown = ids.is_null().to_numpy(zero_copy_only=False)
                for i, item in enumerate(items):
                    if docs.greatest[item].sum() < max(1, least[i]):
                        continue
                    bounds, order = docs.groups(item)
                    member[item] = True
                    at, step = 0, _EVALUATED_TOGETHER
                    while at < len(order) and bounds[at] >= max(1, least[i]):
                        open_to = int((bounds[at : at + step] >= max(1, least[i])).sum())
                        these = order[at : at + open_to]
                        scores = docs.evaluate(these, member)
                        good = scores >= max(1, least[i])
                        these = these[good]
                        scores = np.append(found[i][0], scores[good])
                        names = np.append(found[i][1], docs.ids[these])
                        none = np.append(found[i][2], unknown[these])
                        top = np.lexsort((names, none, -scores))[:best]
                        found[i] = scores[top], names[top], none[top]
                        if len(top) == best:
                            least[i] = scores[top[-1]]
                        at += open_to
                        step *= 2
                    member[item] = False
        sizes = [len(scores) for scores, _, _ in found]
        if not sum(sizes):
            return
        columns = [
            pa.array(np.repeat(np.arange(len(items)), sizes).astype(np.int32)),
            pa.array(
                np.concatenate([names for _, names, _ in found]),
                mask=np.concatenate([none for _, _, none in found]),
            ),
            pa.array(np.concatenate([scores for scores, _, _ in found])),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return run


def _answers(
    spark: SparkSession, docs: DataFrame, items: list, id_type: str, best: int
) -> DataFrame:
    """The best documents of some items, which the driver holds."""
    held = [sorted(set(terms(row.text))) for row in items]
    vocabulary = {term: i for i, term in enumerate(sorted(set(chain.from_iterable(held))))}
    index = docs.mapInArrow(
        _held(vocabulary), "id bigint, n bigint, terms array<int>, counts array<int>"
    )
    index = materialize(spark, index, "terms-held")
    documents, total = index.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    holding = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in holding.collect():  # at most one row for each term of these items
        weights[row.term] = term_weight(documents, row["count"])
    numbers = [np.array([vocabulary[term] for term in each], np.int64) for each in held]
    found = index.mapInArrow(
        _ranked(numbers, weights, documents, total, best), "item int, doc_id bigint, score bigint"
    )
    place = F.row_number().over(
        Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    )
    found = found.withColumn("rank", place).where(F.col("rank") <= best)
    names = spark.createDataFrame(
        [(i, row.item_id) for i, row in enumerate(items)], f"item int, item_id {id_type}"
    )
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    best: int = BEST,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``best`` documents of every item.

    Only scores above 0 count; among equal ones the smaller id comes first.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    asked = asked.where("text IS NOT NULL").distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = size // item_bytes + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    id_type = items.schema[item_col].dataType.simpleString()
    answers = [
        _answers(spark, plain, asked.where(part == i).collect(), id_type, best)
        for i in range(parts)
    ]
    return reduce(DataFrame.unionByName, answers)
