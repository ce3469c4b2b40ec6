"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, word pairs, pairs with one word
between and four-letter word stems, hashed to ``2**BITS`` places. The learner
keeps a rate of its own for each place; the L1 term leaves most weights zero, so
the model is one small array of fixed size, whatever the corpus.

Null and empty texts have the bias as their only feature. Very long texts are
scored whole. Repeated rows get equal scores. Without labelled rows every
score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import materialize, memo, per_text, sampled

BITS = 20
#: Most labelled rows the model is fitted on; they fit into one task.
SAMPLE_ROWS = 12_000
EPOCHS = 10
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.0
#: Weight of a toxic row; toxic rows are the rarer ones.
TOXIC_WEIGHT = 2.0
THRESHOLD = 0.7
_MOST_WORDS_KEPT = 1 << 18
_BIAS = 0


class _Words(dict):
    """Digest of a word (high half) and of its stem (low half), kept for later texts."""

    def __missing__(self, word: str) -> int:
        if len(self) > _MOST_WORDS_KEPT:
            self.clear()
        digest = xxhash.xxh64_intdigest(word) >> 32 << 32 | xxhash.xxh64_intdigest(word[:4]) >> 32
        self[word] = digest
        return digest


def _extractor() -> Callable[[str | None], np.ndarray]:
    words = memo("toxicity_words", _Words)
    find = re.compile(r"\w+").findall
    spread, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
    step, half = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(32)

    def features(text: str | None) -> np.ndarray:
        found = find((text or "").lower())
        packed = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
        word = packed >> half
        parts = [
            word,
            (packed << half) + np.uint64(1),
            word[:-1] * step + word[1:] + np.uint64(2),
            word[:-2] * step + word[2:] + np.uint64(3),
        ]
        return (np.concatenate(parts) * spread >> shift).astype(np.int32)

    return features


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Weights that are not zero after ``EPOCHS`` passes over the sample."""
    rows = rows.sort_values(["label", "features"])
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs = z[at]
        rate = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(zs) > L1, (np.sign(zs) * L1 - zs) / rate, 0.0)

    texts = [np.frombuffer(x, np.int32) for x in rows["features"]]
    labels = rows["label"].to_numpy(float)
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in random.permutation(len(texts)):
            at = texts[i]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            g *= TOXIC_WEIGHT if labels[i] else 1.0
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
    w = weights(slice(None))
    at = np.flatnonzero(w)
    return pd.DataFrame({"place": at.astype(np.int32), "weight": w[at]})


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> np.ndarray:
    """Weights from at most ``sample_rows`` rows of ``labels`` (``doc_id``, ``label``).

    Rows without id or label are left out; of repeated labels the larger counts, of
    several texts with one id the smallest.
    Features are made where the texts lie; the learner, which goes from row to row,
    gets those of the bounded sample.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = sampled(known, F.col("doc_id"), sample_rows)

    @F.pandas_udf("binary")
    def features_of(texts: pd.Series) -> pd.Series:
        features = _extractor()
        return texts.map(lambda t: np.unique(np.append(features(t), _BIAS)).astype("<i4").tobytes())

    # The sample is bounded by sample_rows ids, so it may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = rows.select("label", features_of("text").alias("features"))
    rows = materialize(spark, rows, "toxicity-sample")
    fitted = rows.groupBy().applyInPandas(_fit, "place int, weight double")
    found = fitted.toPandas()  # at most 2**BITS rows
    weights = np.zeros(1 << BITS, np.float32)
    weights[found["place"].to_numpy()] = found["weight"].to_numpy()
    return weights


def scorer(spark: SparkSession, weights: np.ndarray) -> Callable[[Column], Column]:
    """A column function: the score of each whole text, 0 to 1."""
    shared = spark.sparkContext.broadcast(weights)

    def factory() -> Callable[[str | None], tuple]:
        features, w = _extractor(), shared.value

        def score(text: str | None) -> tuple:
            at = features(text)
            at = np.unique(at[w[at] != 0])
            total = float(w[at].sum()) + (0.0 if at.size and at[0] == _BIAS else float(w[_BIAS]))
            return (1 / (1 + float(np.exp(-np.clip(total, -35, 35)))),)

        return score

    udf = per_text("score double", factory)
    return lambda text: udf(text).getField("score")
