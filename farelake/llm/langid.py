"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled with a language, so texts that switch between
languages are labelled part by part. A word's features are its first and last one
to three letters (affixes), its three-letter sequences (n-grams) and the word
itself (lexicon), hashed to ``2**BITS`` places; neighbouring words are tied by
learned transitions. The forward-backward algorithm gives each word's probability
of each language; a text's language is the one with the largest sum, its score the
mean probability of that language over the words.

Null texts and texts without a letter get ``und`` and score 0. Long texts are
read whole. Repeated rows get equal results; ties go to the language that is first
in order. Without a row to learn from, every text is ``und``.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from numpy.typing import NDArray
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import SLOTS, materialize, memo, slot

BITS = 18
#: Most rows of each language, and of all languages, the model is fitted on.
SAMPLE_ROWS = 600
ALL_ROWS = 12_000
#: Most languages the model tells apart; a model of so many has 67 MB.
MOST_LANGUAGES = 64
#: Words in a row from one text, on average, where texts are mixed for training.
STRETCH = 12
SEQUENCE = 64
SHARDS = 4
EPOCHS = 3
UNKNOWN = "und"
_LETTERS = 20
_MOST_WORDS_KEPT = 1 << 18
_WORDS = re.compile(r"[^\W\d_]{1,%d}" % _LETTERS)


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter.

    Longer runs, as of scripts without spaces, are cut into words of ``_LETTERS`` letters, so
    that every letter is read.
    """
    found = _WORDS.findall((text or "").lower())
    return found if any(c.isalpha() for word in found for c in word) else []


def features(words: list[str]) -> NDArray[np.int32]:
    """Hashed features of each word, one row a word; place 0 where a word has fewer."""
    codes = np.array([w[:_LETTERS] for w in words], f"U{_LETTERS}").view(np.uint32)
    codes = codes.reshape(len(words), _LETTERS).astype(np.uint64)
    lengths = (codes != 0).sum(axis=1)
    ends = np.array([w[-3:] for w in words], "U3").view(np.uint32).reshape(-1, 3).astype(np.uint64)
    end_lengths = (ends != 0).sum(axis=1)
    step, spread = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
    made = []

    def add(kind: int, parts: list[NDArray], valid: NDArray) -> None:
        digest = np.full(len(words), kind, np.uint64)
        for part in parts:
            digest = (digest * step ^ part) * spread
            digest ^= digest >> np.uint64(29)
        place = (digest * spread >> np.uint64(64 - BITS)).astype(np.int32)
        made.append(np.where(valid, np.maximum(place, 1), 0).astype(np.int32))

    for n in (1, 2, 3):
        add(n, [codes[:, i] for i in range(n)], lengths >= n)
        tail = [ends[np.arange(len(words)), np.maximum(end_lengths - n + i, 0)] for i in range(n)]
        add(10 + n, tail, end_lengths >= n)
    for start in range(_LETTERS - 2):
        add(20, [codes[:, start + i] for i in range(3)], lengths >= start + 3)
    whole = np.array([hash_of(w) for w in words], np.uint64)
    add(30, [whole], np.ones(len(words), bool))
    return np.column_stack(made)


def hash_of(word: str) -> int:
    """A digest of a whole word, the same in every process."""
    return zlib.crc32(word.encode())


def forward_backward(emitted: NDArray, starts: NDArray, moves: NDArray) -> NDArray:
    """Marginals of every place of sequences laid end to end.

    ``emitted`` (words, languages) are scores, ``starts`` marks first words of
    sequences, ``moves`` (from, to) are scores of transitions. The places are cut
    into blocks of equal length that advance side by side; what one block hands to
    the next is the product of its matrices, so results are exact.
    """
    n, k = emitted.shape
    block = max(1, int(np.sqrt(n)))
    rows = -(-n // block)
    pad = rows * block - n
    local = np.exp(emitted - emitted.max(axis=1, keepdims=True))
    local = np.concatenate([local, np.ones((pad, k))]).reshape(rows, block, k)
    first = np.concatenate([starts, np.zeros(pad, bool)]).reshape(rows, block)
    free = np.ones((k, k))
    move = np.exp(moves)
    # into[r, t]: matrix from the place before to place t.
    step = np.where(first[:, :, None, None], free, move)

    def scaled(x: NDArray) -> NDArray:
        return x / x.sum(axis=(-1,) if x.ndim == 2 else (-2, -1), keepdims=True)

    product = np.broadcast_to(np.eye(k), (rows, k, k))
    for t in range(block):
        product = scaled(product @ step[:, t] * local[:, t, None, :])
    entry, at = np.empty((rows, k)), np.full(k, 1 / k)
    for r in range(rows):
        entry[r] = at
        at = at @ product[r]
        at = at / at.sum()
    exit_, at = np.empty((rows, k)), np.full(k, 1 / k)
    for r in range(rows - 1, -1, -1):
        exit_[r] = at
        at = product[r] @ at
        at = at / at.sum()
    alpha = np.empty((rows, block, k))
    at = entry
    for t in range(block):
        at = scaled((at[:, None, :] @ step[:, t])[:, 0] * local[:, t])
        alpha[:, t] = at
    beta = np.empty((rows, block, k))
    at = exit_
    for t in range(block - 1, -1, -1):
        beta[:, t] = at
        at = scaled((step[:, t] @ (at * local[:, t])[:, :, None])[:, :, 0])
    both = (alpha * beta).reshape(-1, k)[:n]
    return both / both.sum(axis=1, keepdims=True)


def _sequences(rows: pd.DataFrame, random: np.random.Generator) -> tuple[list[str], NDArray]:
    """Words and labels, stretches of different texts in turn, as in text that switches."""
    texts = [(words_of(t), label) for t, label in zip(rows["text"], rows["label"])]
    pieces = []
    for words, label in texts:
        start = 0
        while start < len(words):
            n = 1 + int(random.geometric(1 / STRETCH))
            pieces.append((words[start : start + n], label))
            start += n
    order = random.permutation(len(pieces))
    words = [w for i in order for w in pieces[i][0]]
    labels = np.array([pieces[i][1] for i in order for _ in pieces[i][0]], np.int64)
    return words, labels


def _fit(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Weights and transitions from one shard of the sample, as bytes."""
    random = np.random.default_rng(11)
    rows = rows.sort_values(["label", "text"])
    weights = np.zeros((1 << BITS, k), np.float32)
    squares = np.full((1 << BITS, k), 1e-3, np.float32)
    moves, move_squares = np.zeros((k, k)), np.full((k, k), 1e-3)
    for _ in range(EPOCHS):
        words, labels = _sequences(rows, random)
        n = len(words) // SEQUENCE * SEQUENCE
        batch = 256 * SEQUENCE
        for begin in range(0, n, batch):
            end = min(n, begin + batch)
            unique = list(dict.fromkeys(words[begin:end]))
            number = {w: i for i, w in enumerate(unique)}
            which = np.fromiter((number[w] for w in words[begin:end]), np.int64, end - begin)
            places = features(unique)
            emitted = _emitted(weights, places)[which]
            truth = labels[begin:end].reshape(-1, SEQUENCE)
            marginal, pairs = _marginals(emitted.reshape(-1, SEQUENCE, k), moves)
            gap = marginal.reshape(-1, k)
            gap[np.arange(end - begin), labels[begin:end]] -= 1
            by_word = np.zeros((len(unique), k))
            np.add.at(by_word, which, gap)
            used, back = np.unique(places, return_inverse=True)
            slope = np.zeros((len(used), k))
            np.add.at(slope, back.reshape(places.shape), by_word[:, None, :])
            slope /= (end - begin) / SEQUENCE
            squares[used] += slope**2
            weights[used] -= 0.5 * slope / np.sqrt(squares[used])
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
            slope = (pairs - seen) / len(truth)
            move_squares += slope**2
            moves -= 0.3 * slope / np.sqrt(move_squares)
    weights[0] = 0
    return pd.DataFrame(
        {"weights": [weights.tobytes()], "moves": [moves.astype(np.float32).tobytes()]}
    )


def _emitted(weights: NDArray, places: NDArray) -> NDArray:
    out = np.zeros((len(places), weights.shape[1]), np.float32)
    for column in places.T:
        out += np.where(column[:, None] > 0, weights[column], 0)
    return out


def _marginals(emitted: NDArray, moves: NDArray) -> tuple[NDArray, NDArray]:
    """Marginals of each place, and expected transitions, of sequences of equal length."""
    m, n, k = emitted.shape
    local = np.exp(emitted - emitted.max(axis=2, keepdims=True)).astype(float)
    move = np.exp(moves)
    alpha, beta = np.empty((m, n, k)), np.empty((m, n, k))
    alpha[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, n):
        at = alpha[:, t - 1] @ move * local[:, t]
        alpha[:, t] = at / at.sum(axis=1, keepdims=True)
    beta[:, -1] = 1
    for t in range(n - 2, -1, -1):
        at = (beta[:, t + 1] * local[:, t + 1]) @ move.T
        beta[:, t] = at / at.sum(axis=1, keepdims=True)
    marginal = alpha * beta
    marginal /= marginal.sum(axis=2, keepdims=True)
    pairs = alpha[:, :-1, :, None] * move * (beta[:, 1:] * local[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return marginal, pairs.sum(axis=(0, 1))


class Model:
    """Weights of a fitted field; small and of fixed size for a number of languages."""

    def __init__(self, languages: list[str], weights: NDArray, moves: NDArray) -> None:
        self.languages, self.weights, self.moves = languages, weights, moves

    def predict(self, texts: list[str | None], kept: dict[str, NDArray]) -> list[tuple[str, float]]:
        """Language and score of each text. ``kept``: scores of words met before."""
        split = [words_of(text) for text in texts]
        lengths = np.array([len(words) for words in split], np.int64)
        if not self.languages or not lengths.sum():
            return [(UNKNOWN, 0.0)] * len(texts)
        if len(kept) > _MOST_WORDS_KEPT:
            kept.clear()
        number: dict[str, int] = {}
        which = np.fromiter(
            (number.setdefault(w, len(number)) for words in split for w in words),
            np.int64,
            int(lengths.sum()),
        )
        new = [w for w in number if w not in kept]
        for begin in range(0, len(new), 1 << 15):
            part = new[begin : begin + (1 << 15)]
            kept.update(zip(part, _emitted(self.weights, features(part))))
        emitted = np.array([kept[w] for w in number])[which]
        starts = np.zeros(len(which), bool)
        firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        starts[firsts[lengths > 0]] = True
        marginal = forward_backward(emitted, starts, self.moves)
        sums = np.add.reduceat(marginal, firsts[lengths > 0], axis=0)
        best = sums.argmax(axis=1)
        score = sums[np.arange(len(best)), best] / lengths[lengths > 0]
        found = iter(zip(best, score))
        out = []
        for n in lengths:
            at, s = next(found) if n else (None, 0.0)
            out.append((self.languages[at] if n else UNKNOWN, min(1.0, max(0.0, float(s)))))
        return out


def train(spark: SparkSession, docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``text`` and ``lang`` of at most ``sample_rows`` rows of each language.

    Of more than ``MOST_LANGUAGES`` values, those of the most rows are learned, so what a column with
    dirty values sends to the driver and to tasks is bounded. Rows without text or language are left
    out. Shards of the sample are fitted
    side by side, and the weights averaged.
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = {r["lang"]: r["count"] for r in counted.collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((0, 0)))
    sample_rows = max(1, min(sample_rows, ALL_ROWS // len(languages)))
    share, label = F.lit(0), F.lit(0)
    for i, language in enumerate(languages):
        here = F.col("lang") == language
        share = F.when(here, int(SLOTS * min(1.0, sample_rows / counts[language]))).otherwise(share)
        label = F.when(here, i).otherwise(label)
    chosen = rows.where(slot("langid", "text") < share).select(
        "text", label.alias("label"), F.pmod(F.xxhash64("text"), F.lit(SHARDS)).alias("shard")
    )
    # One row for each text, so that copies don't make the sample larger.
    chosen = materialize(spark, chosen.dropDuplicates(["text", "label"]), "langid-sample")
    k = len(languages)
    fitted = chosen.groupBy("shard").applyInPandas(
        lambda part: _fit(part, k), "weights binary, moves binary"
    )
    fitted = fitted.toPandas()  # SHARDS rows of fixed size
    weights = sum(np.frombuffer(w, np.float32).reshape(-1, k) for w in fitted["weights"])
    moves = sum(np.frombuffer(m, np.float32).reshape(k, k) for m in fitted["moves"])
    return Model(languages, weights / len(fitted), moves / len(fitted))


def predictor(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """Column function: ``lang_pred`` and ``score`` of each whole text."""
    shared = spark.sparkContext.broadcast((model.languages, model.weights, model.moves))
    name = f"langid_{uuid.uuid4().hex}"  # scores of words hold for this model only

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        kept = memo(name, dict)
        made, model = [], Model(*shared.value)
        part: list[str | None] = []
        size = 0
        for text in [*texts, None]:
            part.append(text)
            size += len(text or "")
            if size > 2_000_000:
                made += model.predict(part, kept)
                part, size = [], 0
        made += model.predict(part, kept)
        return pd.DataFrame(made[: len(texts)], columns=["lang_pred", "score"])

    return predict
