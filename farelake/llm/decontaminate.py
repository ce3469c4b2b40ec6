"""Benchmark decontamination: exact containment of benchmark windows in documents.

A window is ``WINDOW`` consecutive words of a benchmark item, or all words of a
shorter one. A document holds a window only if it holds every shingle of it, so one
shingle of each window, the one that is rarest in the documents, is a sufficient
prefix to join on. Steps:

1. Shingles of documents are joined with the set of all benchmark shingles; what
   is found is kept with its position and the words around it. Counts of these
   hits are the rarity of each shingle in the whole corpus.
2. Each window keeps its rarest shingle. A window with a shingle that no document
   has is dropped.
3. Hits meet windows at that shingle only. The shingle's offset in the window
   fixes where the window would start; it must lie inside the document from its
   first to its last word. The words at that place are compared one by one.

Everything is built-in functions. Of the set of benchmark shingles at most about
``BROADCAST_ROWS`` rows (8 bytes each) are broadcast at a time; a larger set takes as many
passes over the texts. Words never move with a shingle that no item has.

Null and empty texts have no words and nothing is hit; items without words have no
windows. Equal items and windows are found all alike. Texts of any length are read
whole. A null item id is listed as an empty string. Documents of the same id and
text are one document read twice; both rows get the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import KEY, ascii_lower, key_of, materialize, packed, unpacked
from farelake.session import scratch_path

WINDOW = 13
SHINGLE = 5
BROADCAST_ROWS = 1_000_000

#: Fixed word rule, for texts in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands for the document itself among its shingles, so that one pass over the
#: texts also gives the number of words of every document.
_ITSELF = -1


def words(text: Column) -> Column:
    """Words of a text in order; none of a null text."""
    # Splitting at what is no word is several times faster than finding words.
    return F.array_remove(F.split(ascii_lower(text), NO_WORD), "")


def _shingle_digests(column: str, n: Column | str, size: int) -> Column:
    """Digests of all runs of ``size`` words, by position; an empty array if there is none."""
    array, count = F.col(column), F.col(n) if isinstance(n, str) else n

    def digest(i: Column) -> Column:
        return F.xxhash64(F.lit(size), *[array[i + k] for k in range(size)])

    made = F.transform(F.sequence(F.lit(0), count - size), digest)
    return F.when(count >= size, made).otherwise(F.array().cast("array<bigint>"))


def _windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows: ``window`` (words), ``size`` and ``items`` (ids as text)."""
    rows = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        words(F.col(text_col)).alias("w"),
    ).where(F.size("w") > 0)
    rows = rows.withColumn("size", F.least(F.lit(WINDOW), F.size("w")))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)
    rows = rows.select("item", "size", "w", F.explode(starts).alias("start"))
    rows = rows.select("item", "size", F.slice("w", F.col("start"), F.col("size")).alias("window"))
    return rows.groupBy("window", "size").agg(F.collect_set("item").alias("items"))


def _window_shingles(windows: DataFrame) -> DataFrame:
    """``shingle`` and its ``offset`` in each window."""
    digests = F.lit(None).cast("array<bigint>")
    for size in range(1, SHINGLE + 1):
        here = F.least(F.lit(SHINGLE), F.col("size")) == size
        digests = F.when(here, _shingle_digests("window", "size", size)).otherwise(digests)
    return windows.select("*", F.posexplode(digests).alias("offset", "shingle"))


def occurrences(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Where windows occur (:data:`KEY`, ``start`` from 0, ``size``, ``items``), and
    the number of words ``n`` of every document (:data:`KEY`)."""
    windows = materialize(
        spark,
        _window_shingles(_windows(items, item_id_col, item_text_col)),
        "benchmark-windows",
    )
    itself = spark.range(1).select(F.lit(_ITSELF).cast("bigint").alias("shingle"))
    sought = windows.select("shingle").union(itself).distinct()
    # What is broadcast is bounded: more shingles are as many passes over the texts.
    parts = -(-sought.count() // max(1, BROADCAST_ROWS))
    # At most SHINGLE different sizes.
    sizes = windows.select(F.least(F.lit(SHINGLE), F.col("size")).alias("s")).distinct()
    sizes = sorted(row["s"] for row in sizes.collect()) or [SHINGLE]

    texts = docs.select(*key_of(id_col, text_col), words(F.col(text_col)).alias("w"))
    texts = texts.select("*", F.size("w").alias("n"))
    digests = [_shingle_digests("w", "n", size) for size in sizes]
    if len(sizes) == 1:
        # The document itself comes last, at the place after its last shingle.
        every = F.concat(digests[0], F.array(F.lit(_ITSELF).cast("bigint")))
        rows = texts.select(*KEY, "n", "w", F.posexplode(every).alias("at", "shingle"))
    else:
        itself = F.struct(F.lit(0).alias("at"), F.lit(_ITSELF).cast("bigint").alias("shingle"))
        places = [
            F.transform(d, lambda x, i: F.struct(i.alias("at"), x.alias("shingle")))
            for d in digests
        ]
        every = F.concat(F.array(itself), *places)
        rows = texts.select(*KEY, "n", "w", F.explode(every).alias("p"))
        rows = rows.select(*KEY, "n", "w", "p.*")
    # Words that any window around the shingle can reach.
    since = F.greatest(F.lit(0), F.col("at") - (WINDOW - 1))
    near = F.slice("w", since + 1, F.lit(2 * WINDOW - 1))
    path = scratch_path(spark, "benchmark-hits")
    for part in range(parts):
        some = sought.where(F.pmod("shingle", F.lit(parts)) == part) if parts > 1 else sought
        hits = rows.join(F.broadcast(some), "shingle").select(
            *KEY,
            "n",
            "at",
            "shingle",
            since.alias("since"),
            F.when(F.col("shingle") != _ITSELF, near).alias("near"),
        )
        hits.write.mode("append").parquet(path)
    hits = spark.read.schema(hits.schema).parquet(path)

    counts = hits.where(F.col("shingle") == _ITSELF).select(*KEY, "n")
    rarity = hits.groupBy("shingle").agg(F.count("*").alias("found"))
    ranked = windows.join(rarity, "shingle", "left").groupBy("window", "size", "items")
    prefix = (
        ranked.agg(
            F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "shingle", "offset"))
            .alias("rarest")
        )
        .where("rarest.found > 0")
        .select("window", "size", "items", "rarest.shingle", "rarest.offset")
    )
    prefix = materialize(spark, prefix, "benchmark-prefix")
    start = F.col("at") - F.col("offset")
    found = (
        hits.join(prefix, "shingle")
        .where((start >= 0) & (start + F.col("size") <= F.col("n")))
        .where(F.slice("near", start - F.col("since") + 1, F.col("size")) == F.col("window"))
        .select(*KEY, start.alias("start"), "size", "items")
    )
    return found, counts


def _covered() -> Column:
    """Number of words inside the union of ``spans`` (start, size), sorted by start."""
    state = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("reach"))

    def step(state: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        new = F.greatest(F.lit(0), end - F.greatest(span["start"], state["reach"]))
        return F.struct(
            (state["covered"] + new).alias("covered"),
            F.greatest(state["reach"], end).alias("reach"),
        )

    return F.aggregate(F.array_sort("spans"), state, step, lambda state: state["covered"])


def contamination(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per :data:`KEY`: ``n_words``, ``n_hit``, ``items`` (sorted ids), ``contaminated``."""
    found, counts = occurrences(
        spark, docs, items, id_col, text_col, item_id_col, item_text_col
    )
    found = found.groupBy(*KEY).agg(
        F.collect_set(F.struct("start", "size")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    counts = counts.groupBy(*KEY).agg(F.max("n").cast("bigint").alias("n_words"))
    rows = counts.join(found, KEY, "left").select(
        *KEY,
        "n_words",
        F.coalesce(_covered(), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return rows.select("*", is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A document is contaminated if a twentieth of its words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: the id, word counts, item ids and the verdict."""
    found = contamination(spark, docs, items, id_col, text_col, item_id_col, item_text_col)
    named = docs.select(*key_of(id_col, text_col), F.col(id_col).alias("doc_id"))
    return named.join(found, KEY).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def without_contaminated(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with all columns."""
    found = contamination(spark, docs, items, id_col, text_col).where("contaminated")
    rows = packed(docs, id_col, text_col).join(found.select(*KEY).hint("merge"), KEY, "left_anti")
    return unpacked(rows, docs.columns)
