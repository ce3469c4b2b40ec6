"""Quality classifier: weak labels, their accuracies by expectation-maximisation, and a scorer.

No hand-made labels are used. Overlapping heuristic labellers look at the whole of
every text and vote good, bad or nothing. The votes of one text are a pattern;
there are at most ``3 ** len(LABELLERS)`` patterns, and their counts over all
documents are all that expectation-maximisation needs to estimate how often each
labeller votes what on good and on bad texts. That gives each pattern a posterior
probability of being good. Posteriors of a bounded sample of documents then train a
linear scorer over hashed words and marks, which scores every whole text.

Null and empty texts have no features but the bias; a labeller votes bad on them.
Texts of any length are read whole. Repeated rows get equal results. With one
pattern only, or an empty table, the posterior is that of the labellers' prior.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from numpy.typing import NDArray
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import materialize, memo, sampled

BITS = 18
#: Most documents the scorer is fitted on.
SAMPLE_ROWS = 8_000
SHARDS = 4
EPOCHS = 6
GOOD, BAD, NOTHING = 2, 1, 0
_BIAS, _AGAIN = 0, 1
_MOST_WORDS_KEPT = 1 << 18
_ROUNDS = 200
#: A labeller's accuracy before anything is known, and how many votes that is worth.
_PRIOR, _WORTH = 0.75, 20.0
#: Common short words of the main languages: fixed values.
_COMMON = (
    "the of and to in a is that for it as was with be by on are this from or an they which "
    "der die und das ist nicht ein eine zu den von mit sich auf für im dem des "
    "de la le les et des en un une du est que qui dans pour par sur pas au avec "
    "el los las y se del por con una su para es no lo"
).split()
_COMMON_SET = frozenset(_COMMON)
_MARKS = "#$%&*|!<>{}[]~^=\\"
# Classes of letters: bits of a table for the code points below its length.
_LETTER, _UPPER, _DIGIT, _MARK, _SPACE = 1, 2, 4, 8, 16
_TABLE_SIZE = 0x3000


def _classes() -> NDArray[np.uint8]:
    table = np.zeros(_TABLE_SIZE + 1, np.uint8)
    for code in range(_TABLE_SIZE):
        c = chr(code)
        table[code] = (
            _LETTER * c.isalpha() | _UPPER * c.isupper() | _DIGIT * c.isdigit()
            | _MARK * (c in _MARKS) | _SPACE * c.isspace()
        )
    table[_TABLE_SIZE] = _LETTER  # what lies beyond
    return table


def counts_of(text: str, table: NDArray) -> dict[str, int]:
    """What the labellers look at: numbers of letters of some classes, and of words."""
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), _TABLE_SIZE)
    found = np.bincount(table[codes], minlength=32)
    bits = np.arange(len(found))
    number = lambda bit: int(found[(bits & bit) != 0].sum())
    words, data = text.split(), text.encode()
    return {
        "n": len(text),
        "letters": number(_LETTER),
        "upper": number(_UPPER),
        "digits": number(_DIGIT),
        "marks": number(_MARK),
        "words": len(words),
        "stops": sum(map(text.count, (". ", ".\n", "? "))) + text.endswith((".", "?")),
        "common": sum(map(_COMMON_SET.__contains__, map(str.lower, words))),
        "repeats": sum(map(operator.eq, words, words[1:])),
        "distinct": len(set(words)),
        "bytes": len(data),
        "packed": len(zlib.compress(data, 1)),
    }


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else NOTHING


#: Votes of each labeller from the counts ``c``. Most know a fault and say nothing without it.
LABELLERS: dict[str, Callable[[dict[str, int]], int]] = {
    "length": lambda c: _vote(c["n"] < 60, c["n"] > 200),
    "marks": lambda c: _vote(c["marks"] > 0.03 * c["n"], False),
    "upper": lambda c: _vote(c["upper"] > 0.4 * c["letters"], False),
    "letters": lambda c: _vote(c["letters"] < 0.65 * c["n"], c["letters"] > 0.75 * c["n"]),
    "sentences": lambda c: _vote(c["stops"] * 120 < c["words"], c["stops"] * 40 > c["words"]),
    "word_length": lambda c: _vote(not 3 <= c["n"] / (c["words"] or 1) <= 12, False),
    "common": lambda c: _vote(c["common"] * 25 < c["words"], c["common"] * 12 > c["words"]),
    "repeats": lambda c: _vote(c["repeats"] * 8 > c["words"], c["repeats"] * 40 < c["words"]),
    "variety": lambda c: _vote(
        c["words"] > 30 and c["distinct"] < 2.2 * c["words"] ** 0.5, c["distinct"] * 4 > c["words"]
    ),
    "packed": lambda c: _vote(c["packed"] < 0.25 * c["bytes"], c["packed"] > 0.35 * c["bytes"]),
}


def pattern_of(text: str | None, table: NDArray) -> int:
    """The votes on a whole text, as one number in base three."""
    counts = counts_of(text or "", table)
    return sum(labeller(counts) * 3**i for i, labeller in enumerate(LABELLERS.values()))


def accuracies(patterns: NDArray, counts: NDArray) -> tuple[NDArray, NDArray, float]:
    """Expectation-maximisation over counts of patterns.

    Returns the posterior of good for each pattern, each labeller's vote
    probabilities (labeller, class, vote) and the share of good texts. The first
    posterior is the share of good votes, so "good" means what labellers call good.
    """
    k = len(LABELLERS)
    cast = np.column_stack([patterns // 3**i % 3 for i in range(k)])
    good, bad = (cast == GOOD).sum(axis=1), (cast == BAD).sum(axis=1)
    posterior = (good + 0.5) / (good + bad + 1.0) * np.where(bad > 0, 0.6, 1.0)
    prior_votes = np.full((2, 3), 1 / 3)
    prior_votes[1] = [1 / 3, (1 - _PRIOR) * 2 / 3, _PRIOR * 2 / 3]
    prior_votes[0] = [1 / 3, _PRIOR * 2 / 3, (1 - _PRIOR) * 2 / 3]
    table, share = np.empty((k, 2, 3)), 0.5
    for _ in range(_ROUNDS):
        weights = np.stack([counts * (1 - posterior), counts * posterior])
        for i in range(k):
            for y in (0, 1):
                seen = np.bincount(cast[:, i], weights[y], minlength=3) + _WORTH * prior_votes[y]
                table[i, y] = seen / seen.sum()
        share = (weights[1].sum() + 1) / (counts.sum() + 2)
        odds = np.log(share / (1 - share)) + sum(
            np.log(table[i, 1][cast[:, i]]) - np.log(table[i, 0][cast[:, i]]) for i in range(k)
        )
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return posterior, table, share


class _Tokens(dict):
    def __missing__(self, token: str) -> int:
        if len(self) > _MOST_WORDS_KEPT:
            self.clear()
        place = xxhash.xxh64_intdigest(token) >> (64 - BITS)
        place = max(place, 2)
        self[token] = place
        return place


def _extractor() -> Callable[[str], tuple[NDArray, NDArray]]:
    tokens = memo("quality_tokens", _Tokens)
    find = re.compile(r"\w+|[^\w\s]+").findall
    digits = re.compile(r"[0-9]").sub

    def features(text: str | None) -> tuple[NDArray, NDArray]:
        """Places and values: counts dampened and scaled to unit length, and the bias."""
        found = find(digits("0", text or ""))
        places = np.fromiter(map(tokens.__getitem__, found), np.int64, len(found))
        # A word that follows itself counts for one feature more.
        again = np.full(int((places[1:] == places[:-1]).sum()), _AGAIN)
        places = np.concatenate([places, again])
        at, n = np.unique(places, return_counts=True)
        value = 1 + np.log(n)
        norm = float(np.sqrt((value**2).sum())) or 1.0
        return np.append(at, _BIAS), np.append(value / norm, 1.0)

    return features


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Linear weights from texts and posteriors of one shard, by adaptive gradient steps."""
    features = _extractor()
    rows = rows.sort_values(["posterior", "text"])
    texts = [features(text) for text in rows["text"]]
    targets = rows["posterior"].to_numpy(float)
    w, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-2)
    random = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in random.permutation(len(texts)):
            at, x = texts[i]
            gap = 1 / (1 + np.exp(-np.clip(w[at] @ x, -30, 30))) - targets[i]
            slope = gap * x + 1e-5 * w[at]
            squares[at] += slope**2
            w[at] -= 0.5 * slope / np.sqrt(squares[at])
    at = np.flatnonzero(w)
    return pd.DataFrame({"place": at.astype(np.int32), "weight": w[at]})


def classify(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``pattern``, ``posterior``, ``score``, ``predicted``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    @F.pandas_udf("int")
    def pattern(texts: pd.Series) -> pd.Series:
        table = _classes()
        return pd.Series([pattern_of(text, table) for text in texts], dtype="int32")

    found = rows.groupBy(pattern("text").alias("pattern")).count()
    found = found.toPandas()  # at most 3 ** labellers rows
    patterns, counts = found["pattern"].to_numpy(np.int64), found["count"].to_numpy(float)
    known = np.full(3 ** len(LABELLERS), 0.5)
    if len(patterns):
        known[patterns] = accuracies(patterns, counts)[0]
    known = spark.sparkContext.broadcast(known)

    @F.pandas_udf("double")
    def posterior_of(patterns: pd.Series) -> pd.Series:
        return pd.Series(known.value[patterns.to_numpy(np.int64)])

    chosen = sampled(rows, F.struct("doc_id", "text"), sample_rows).distinct()
    sample = chosen.select(
        F.coalesce("text", F.lit("")).alias("text"),
        posterior_of(pattern("text")).alias("posterior"),
        F.pmod(F.xxhash64("text"), F.lit(SHARDS)).alias("shard"),
    )
    sample = materialize(spark, sample, "quality-sample")
    fitted = sample.groupBy("shard").applyInPandas(
        lambda part: _fit(part), "place int, weight double"
    )
    mean = fitted.groupBy("place").agg((F.sum("weight") / SHARDS).alias("weight"))
    mean = mean.toPandas()  # at most 2 ** BITS rows
    weights = np.zeros(1 << BITS)
    weights[mean["place"].to_numpy()] = mean["weight"].to_numpy()
    shared = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        features, w = _extractor(), shared.value

        def one(text: str) -> float:
            at, x = features(text)
            return 1 / (1 + float(np.exp(-np.clip(w[at] @ x, -30, 30))))

        return pd.Series([one(text) for text in texts], dtype=float)

    scored = rows.select(
        "doc_id",
        pattern("text").alias("pattern"),
        posterior_of(pattern("text")).alias("posterior"),
        score("text").alias("score"),
    )
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
