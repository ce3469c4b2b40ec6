"""A training corpus from raw documents: five stages, each one operator of farelake.llm.

Every stage takes what its predecessor kept and works on all of it. All but the last
return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import bpe, decontaminate, linededup, simhash, toxicity
from farelake.llm.common import materialize
from farelake.llm.queries import table, toxicity_labels, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold of rejection."""
    weights = toxicity.train(spark, docs, toxicity_labels(spark, sf_dir))
    score = toxicity.scorer(spark, weights)(F.col("text"))
    return docs.where(score < toxicity.THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of long runs of lines."""
    kept = linededup.without_repeated_lines(spark, docs)
    if "n_chars" not in kept.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    The SimHash operator with the shingle length and the distance of its contract.
    """
    return simhash.one_of_each(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.without_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of the ids and of the text decoded from them."""
    made = docs.select("doc_id", bpe.coded(vocabulary())("text").alias("made"))
    return made.select("doc_id", "made.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Scores of a fitted model and XXH64 are beyond DuckDB's SQL; tests compare brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
