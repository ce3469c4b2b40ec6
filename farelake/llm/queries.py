"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import (
    bpe,
    ctph,
    decontaminate,
    gridcodes,
    html,
    langid,
    lexical,
    linededup,
    quality,
    secrets,
    simhash,
    substrings,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the vocabulary file on this machine, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = docs.select("doc_id", bpe.digests(vocabulary())("text").alias("made"))
    return made.select("doc_id", "made.*")


def remainder(modulus: int) -> F.Column:
    """crc32 of the id's digits, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learned from: those of rows that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return labels.where(remainder(3) != 1)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    score = toxicity.scorer(spark, toxicity.train(spark, docs, toxicity_labels(spark, sf_dir)))
    scored = docs.select(
        "doc_id",
        F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"),
        score(F.col("text")).alias("score"),
    )
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("*", predicted)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.report(spark, docs, table(spark, sf_dir, "benchmark"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.edit_report(spark, table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(spark, table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = linededup.line_dedup(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "row.doc_id",
        "cut.n_lines",
        "cut.n_removed",
        F.sha2(F.coalesce("cut.text", F.lit("")), 256).alias("text_sha256"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    model = langid.train(spark, docs.where(~held_out).select("text", "lang"))
    found = langid.predictor(spark, model)(F.col("text")).alias("found")
    return docs.select("doc_id", held_out.alias("held_out"), found).select(
        "doc_id", "held_out", "found.*"
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.substring_dedup(spark, docs).select(
        "row.doc_id",
        "cut.n_words",
        "cut.n_removed",
        F.sha2(F.coalesce("cut.text", F.lit("")), 256).alias("kept_sha256"),
    )


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = gridcodes.encode(spark, table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontaminate": op2_decontaminate,
    "op3_bpe": op3_bpe,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_fingerprints": op6_fingerprints,
    "op7_main_text": op7_main_text,
    "op8_line_dedup": op8_line_dedup,
    "op9_language": op9_language,
    "op10_simhash": op10_simhash,
    "op11_substrings": op11_substrings,
    "op12_search": op12_search,
    "op13_vector_codes": op13_vector_codes,
}
