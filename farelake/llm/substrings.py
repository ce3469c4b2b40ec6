"""Substring dedup: documents as factors of documents with smaller ids.

Relative Lempel-Ziv parsing writes a text as factors, each a stretch that occurs in a
reference. Here every document is a reference for those with larger ids, and a factor
counts if it has ``window`` words or more; its words are removed.

The reference index has an entry for each window of ``window`` words that more than one
document may hold, dealt out by the digest of its words: each part of it is a block of
references. Looking up every window of a document in the block its digest points to
parses the document against all blocks at once: consecutive windows that are found make up a
factor, and where a factor ends the windows across its end have been looked up on their own, so
a stretch whose copies lie in several references is found whole.

Not every window is moved:

* A text that a smaller id holds as a whole loses all its words, if it has a window at all. Only
  the first document of each text is parsed.
* A window is named by the least digest of the shingles of ``shingle`` words in it. Windows
  with the same words have the same name, and neighbours mostly share one, so there are
  about a fifth as many names as words. Only windows whose name occurs in two texts
  go into the index. Names are a filter and no more: equal ones prove nothing.
* A task first parses its own documents against each other. What it finds is settled
  there; of equal windows only that of its smallest id goes on, and one for all places of a text that
  repeats itself. So the windows of a passage that a third of all documents hold
  are as many as there are tasks, never as many as there are documents.

Digests of windows have 96 bits, those of texts 128. Windows are judged on the input, not on what is left.

Null and empty texts have no words and stay as they are. A null id is smaller than none and
none is smaller than it, so such rows lose nothing and take nothing. Rows of one id never take
from each other, whether their texts are equal or not. Texts of any length are read whole.
Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from numpy.typing import NDArray
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm.common import materialize

WINDOW = 13
SHINGLE = 5
#: Bytes of text, or one text, whose words are digested at a time.
_BLOCK_BYTES = 2 << 20
#: Names or windows that a task puts in order at a time.
_SETTLED_TOGETHER = 1 << 19

_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: NDArray) -> NDArray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def _weighted(digests: NDArray, n: int, first: int) -> NDArray:
    """A digest of each ``n`` consecutive words."""
    size = len(digests) - n + 1
    out = digests[:size] * _FACTORS[first]
    for i in range(1, n):
        out += digests[i : size + i] * _FACTORS[(first + i) % 256]
    return out


def _least_of(values: NDArray, n: int) -> NDArray:
    """The least of each ``n`` consecutive values."""
    width = 1
    size = len(values) - n + 1
    while 2 * width <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[:size], values[n - width : n - width + size])


class _Block:
    """The windows of some texts: word digests, and where windows start."""

    def __init__(self, texts: list[bytes], window: int, shingle: int) -> None:
        words = [text.split() for text in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        digests = map(xxhash.xxh3_64_intdigest, chain.from_iterable(words))
        self.digests = np.fromiter(digests, np.uint64, counts.sum())
        self.window = window
        places = max(0, len(self.digests) - window + 1)
        self.at = np.repeat(np.arange(len(words)), counts)[:places]
        self.start = np.arange(places) - np.repeat(np.cumsum(counts) - counts, counts)[:places]
        self.inside = self.start + window <= counts[self.at]
        self.names = np.empty(0, np.uint64)
        if places:
            shingles = _mixed(_weighted(self.digests, shingle, 0))
            self.names = _least_of(shingles, window - shingle + 1)

    def windows(self, places: NDArray) -> tuple[NDArray, NDArray]:
        """Digests of the windows that start at some places, of 64 and 32 bits."""
        one = np.zeros(len(places), np.uint64)
        two = np.zeros(len(places), np.uint64)
        for i in range(self.window):
            word = self.digests[places + i]
            one += word * _FACTORS[i % 256]
            two += (word ^ (word >> np.uint64(33))) * _FACTORS[(i + 128) % 256]
        return _mixed(one).view(np.int64), (_mixed(two) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _blocks(
    batches: Iterator[pa.RecordBatch], columns: list[str], packed: bool
) -> Iterator[tuple[list[list], list[bytes]]]:
    """The values of some columns, and the texts, of as many rows as make a block."""
    unpack = zstandard.ZstdDecompressor().decompress
    rows: list[tuple] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        values = zip(*(batch.column(name).to_pylist() for name in columns))
        for row, text in zip(values, batch.column("text")):
            if packed:
                text = unpack(text.as_py())
            else:
                text = (text.as_py() or "").encode()
            rows.append(row)
            texts.append(text)
            size += len(text)
            if size >= _BLOCK_BYTES:
                yield list(map(list, zip(*rows))), texts
                rows, texts, size = [], [], 0
    if rows:
        yield list(map(list, zip(*rows))), texts


def _changes(*columns: NDArray) -> NDArray:
    """Whether a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _names(window: int, shingle: int):
    """Names of windows and the digests of the texts that hold them.

    A name that two texts of a task hold is known to be shared: the texts get it in ``known``, and
    only the least and the greatest of them go on to tell other tasks.
    """

    def settled(names: NDArray, keys: NDArray) -> pa.RecordBatch:
        order = np.lexsort((keys, names))
        names, keys = names[order], keys[order]
        new = _changes(names, keys)
        names, keys = names[new], keys[new]
        first = _changes(names)
        last = np.append(first[1:], True)
        sent = first | last
        shared = ~(first & last)
        order = np.argsort(keys[shared], kind="stable")
        known, owner = names[shared][order].view(np.int64), keys[shared][order]
        starts = np.flatnonzero(_changes(owner))
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(starts, len(owner)).astype(np.int32)), pa.array(known)
        )
        # Rows with known names have none of their own; their text deals them out.
        own = owner[starts]
        columns = [
            pa.array(np.append(names[sent].view(np.int64), own)),
            pa.array(np.append(keys[sent], own)),
            pa.concat_arrays([pa.nulls(int(sent.sum()), pa.list_(pa.int64())), lists]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["name", "k1", "known"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[NDArray, NDArray]] = []
        size = 0
        for (keys,), texts in _blocks(batches, ["k1"], False):
            block = _Block(texts, window, shingle)
            names, at = block.names[block.inside], block.at[block.inside]
            new = _changes(names, at)
            held.append((names[new], np.array(keys, np.int64)[at[new]]))
            size += int(new.sum())
            if size >= _SETTLED_TOGETHER:
                yield settled(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield settled(*map(np.concatenate, zip(*held)))

    return run


#: How a stretch of words is one number: its start, whether it is settled, its length.
_START, _SETTLED = 1 << 32, 1 << 31


def _windows(window: int, shingle: int):
    """Windows with shared names, and what is settled in the task as stretches of words.

    A window that a smaller id of the task holds too is settled. The rest are entries of
    the index, each with the other places of its text where the same words start.
    """

    def settled(one, two, ids, tags, start) -> pa.RecordBatch:
        order = np.lexsort((start, tags, ids, two, one))
        one, two, ids, tags, start = (c[order] for c in (one, two, ids, tags, start))
        new = _changes(one, two, ids, tags, start)
        one, two, ids, tags, start = (c[new] for c in (one, two, ids, tags, start))
        first = np.flatnonzero(_changes(one, two))
        least = np.repeat(ids[first], np.diff(np.append(first, len(ids))))
        sure = ids > least
        order = np.lexsort((start[sure], tags[sure], ids[sure]))
        s_ids, s_tags, s_start = (c[sure][order] for c in (ids, tags, start))
        # Stretches of windows that start one behind the other.
        new = np.flatnonzero(_changes(s_ids, s_tags, s_start - np.arange(len(s_start))))
        lengths = np.diff(np.append(new, len(s_start))) + window - 1
        one, two, ids, tags, start = (c[~sure] for c in (one, two, ids, tags, start))
        entry = np.flatnonzero(_changes(one, two, ids, tags))
        upto = np.append(entry[1:], len(start))[: len(entry)]
        others = [
            zlib.compress(np.diff(start[a:b]).astype("<i4").tobytes(), 1) if b - a > 1 else None
            for a, b in zip(entry.tolist(), upto.tolist())
        ]
        columns = [
            np.append(tags[entry], s_tags[new]),
            np.append(ids[entry], s_ids[new]),
            # A settled stretch is no entry; its place deals it out.
            np.append(one[entry], _mixed((s_ids[new] + s_start[new]).view(np.uint64)).view(np.int64)),
            np.append(two[entry], s_start[new].astype(np.int32)),
            np.append(start[entry] * _START + window, s_start[new] * _START + _SETTLED + lengths),
        ]
        rows = [*map(pa.array, columns), pa.array(others + [None] * len(new), pa.binary())]
        made = ["tag", "id", "one", "two", "stretch", "others"]
        return pa.RecordBatch.from_arrays(rows, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[NDArray, ...]] = []
        size = 0
        for (ids, tags, shared), texts in _blocks(batches, ["id", "tag", "shared"], True):
            block = _Block(texts, window, shingle)
            wanted = np.unique(np.concatenate([np.array(s, np.int64) for s in shared])).view(np.uint64)
            places = np.flatnonzero(block.inside & np.isin(block.names, wanted))
            at = block.at[places]
            of_row = (np.array(x, np.int64)[at] for x in (ids, tags))
            held.append((*block.windows(places), *of_row, block.start[places]))
            size += len(places)
            if size >= _SETTLED_TOGETHER:
                yield settled(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield settled(*map(np.concatenate, zip(*held)))

    return run


def _zip(texts: pd.Series) -> pd.Series:
    """Texts as they are moved between tasks, twice: a third of their size."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return texts.map(lambda text: None if text is None else pack(text.encode()))


def _cutter(window: int):
    def stretches(found: list | None) -> Iterator[tuple[int, int]]:
        for row in [] if found is None else found:
            start, length = divmod(int(row["stretch"]), _START)
            length %= _SETTLED
            yield start, start + length
            if row["others"] is not None:
                steps = np.frombuffer(zlib.decompress(row["others"]), "<i4")
                for other in (start + np.cumsum(steps)).tolist():
                    yield other, other + length

    def cut(text: bytes | None, found: list | None, copy: bool | None) -> tuple:
        if text is None:
            return None, 0, 0, []
        words = zstandard.ZstdDecompressor().decompress(text).split()
        spans: list[list[int]] = []
        for start, end in sorted(stretches(found)):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([start, end])
        if copy and len(words) >= window:
            spans = [[0, len(words)]]
        kept, last = [], 0
        for start, end in spans:
            kept += words[last:start]
            last = end
        kept += words[last:]
        left = b" ".join(kept).decode()
        return left, len(words), len(words) - len(kept), [{"start": s, "end": e} for s, e in spans]

    def run(texts: pd.Series, stretches: pd.Series, copies: pd.Series) -> pd.DataFrame:
        rows = [cut(*row) for row in zip(texts, stretches, copies)]
        return pd.DataFrame(rows, columns=["text", "n_words", "n_removed", "spans"])

    return run


def _zipped(text: str) -> Column:
    return F.pandas_udf(_zip, "binary")(text)


#: A document by its id and a digest of its text.
_PLACE = ["id", "k1", "k2"]


def _digests(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def factors(
    spark: SparkSession, docs: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """Documents that lose words: ``id``, ``k1``, ``k2``, and ``stretches`` or ``copy``.

    ``docs`` has the columns ``id`` (bigint) and ``text``. A stretch is start * 2**32 plus
    its length, with bit 31 for those settled in a task, and ``others`` the steps to other
    places of the same words; ``copy`` marks texts of a smaller id.
    """
    if not 0 < shingle <= window:
        raise ValueError("a window holds one shingle at least")
    known = docs.where("id IS NOT NULL AND text IS NOT NULL").select(
        "id", *_digests("text"), "text"
    )
    places = materialize(spark, known.select(*_PLACE), "text-places")
    texts = materialize(
        spark, places.groupBy("k1", "k2").agg(F.min("id").alias("least")), "texts"
    )
    copies = places.join(texts.hint("merge"), ["k1", "k2"]).where("id > least")
    copies = copies.select(*_PLACE).distinct()

    names = known.select("k1", "text").mapInArrow(
        _names(window, shingle), "name bigint, k1 bigint, known array<bigint>"
    )
    same = Window.partitionBy("name")
    own = F.when(F.col("known").isNull(), F.col("k1"))
    shared = (
        names.withColumns({"least": F.min(own).over(same), "greatest": F.max(own).over(same)})
        .where("known IS NOT NULL OR least < greatest")
        .select("k1", F.coalesce("known", F.array("name")).alias("names"))
        .groupBy("k1")
        .agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("shared"))
    )
    # Where an id has several texts, a digest tells them apart; nearly all have 0 instead.
    several = texts.groupBy("least").count().where("count > 1").select("least", F.lit(True).alias("more"))
    parsed = texts.join(several, "least", "left").select(
        F.col("least").alias("id"), "k1", "k2", F.when(F.col("more"), F.col("k1")).otherwise(0).alias("tag")
    )
    parsed = materialize(spark, parsed.join(shared, "k1"), "shared-names")

    moved = known.select(*_PLACE, _zipped("text").alias("text"))
    entries = (
        moved.join(parsed.hint("merge"), _PLACE)
        .select("id", "tag", "shared", "text")
        .mapInArrow(
            _windows(window, shingle),
            "tag bigint, id bigint, one bigint, two int, stretch bigint, others binary",
        )
    )
    settled = F.col("stretch").bitwiseAND(F.lit(_SETTLED)) != 0
    first = F.min(F.when(~settled, F.col("id"))).over(Window.partitionBy("one", "two"))
    found = entries.withColumn("first", first).where(settled | (F.col("first") < F.col("id")))
    found = found.groupBy("id", "tag").agg(F.collect_list(F.struct("stretch", "others")).alias("stretches"))
    found = found.join(parsed.drop("shared"), ["id", "tag"]).select(
        *_PLACE, "stretches", F.lit(False).alias("copy")
    )
    whole = copies.select(
        *_PLACE, F.lit(None).cast(found.schema["stretches"].dataType).alias("stretches"), F.lit(True).alias("copy")
    )
    return materialize(spark, found.unionByName(whole), "factors")


def substring_dedup(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``row`` (the input row without its text) and ``cut`` for every row of ``docs``.

    ``cut`` has the ``text`` of the kept words joined by one space (null stays null),
    ``n_words``, ``n_removed``, and the ``spans`` of words removed.
    """
    number = F.col(id_col).cast("bigint")
    plain = docs.select(number.alias("id"), F.col(text_col).alias("text"))
    found = factors(spark, plain, window, shingle)
    rest = [F.col(f"`{name}`") for name in docs.columns if name != text_col]
    rows = docs.select(
        F.struct(*rest).alias("row"), number.alias("number"), F.col(text_col).alias("text")
    ).select(
        "row",
        # Rows without an id have no factors; a digest deals them out.
        F.coalesce("number", F.xxhash64("text")).alias("id"),
        F.col("number").isNull().alias("without"),
        *_digests("text"),
        _zipped("text").alias("zipped"),
    )
    found = found.withColumn("without", F.lit(False)).hint("merge")
    rows = rows.join(found, [*_PLACE, "without"], "left")
    cut = F.pandas_udf(
        _cutter(window),
        "text string, n_words long, n_removed long, spans array<struct<start:int,end:int>>",
    )
    return rows.select("row", cut("zipped", "stretches", "copy").alias("cut"))
