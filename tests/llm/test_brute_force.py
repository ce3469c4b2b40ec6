"""What SQL cannot say, done again in plain loops: votes and their posteriors, the learner of
toxicity, rolling hashes and edit distance, and sums over all labellings of a text."""

from __future__ import annotations

import itertools
import math
import os
import re
import zlib

import numpy as np
import xxhash
from oracle_compare import connect
from pyspark.sql import functions as F
from test_operators import frame, toxic_corpus

from farelake.llm import ctph, langid, quality, toxicity
from farelake.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def documents():
    rows = connect(SF_DIR).execute("SELECT doc_id, text FROM documents ORDER BY doc_id")
    return dict(rows.fetchall())


# Quality: votes of every text, and expectation-maximisation over rows instead of patterns


def votes(text):
    """The ten votes on a text: 2 good, 1 bad, 0 nothing."""
    text = text or ""
    n, words = len(text), text.split()
    letters = sum(c.isalpha() or ord(c) >= 0x3000 for c in text)
    upper = sum(c.isupper() and ord(c) < 0x3000 for c in text)
    marks = sum(c in "#$%&*|!<>{}[]~^=\\" for c in text)
    stops = text.count(". ") + text.count(".\n") + text.count("? ")
    stops += text.endswith(".") or text.endswith("?")
    common = sum(w.lower() in quality._COMMON for w in words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    size, packed = len(text.encode()), len(zlib.compress(text.encode(), 1))
    distinct = len(set(words))
    judged = [
        (n < 60, n > 200),
        (marks > 0.03 * n, False),
        (upper > 0.4 * letters, False),
        (letters < 0.65 * n, letters > 0.75 * n),
        (stops * 120 < len(words), stops * 40 > len(words)),
        (not 3 <= n / (len(words) or 1) <= 12, False),
        (common * 25 < len(words), common * 12 > len(words)),
        (again * 8 > len(words), again * 40 < len(words)),
        (len(words) > 30 and distinct < 2.2 * len(words) ** 0.5, distinct * 4 > len(words)),
        (packed < 0.25 * size, packed > 0.35 * size),
    ]
    return [1 if bad else 2 if good else 0 for bad, good in judged]


def posteriors(cast):
    """Probability of good for each row of votes, row by row."""
    found = []
    for row in cast:
        good, bad = row.count(2), row.count(1)
        found.append((good + 0.5) / (good + bad + 1) * (0.6 if bad else 1))
    before = {0: [1 / 3, 0.5, 1 / 6], 1: [1 / 3, 1 / 6, 0.5]}
    for _ in range(200):
        table = [[[20 * p for p in before[y]] for y in (0, 1)] for _ in range(10)]
        for row, p in zip(cast, found):
            for i, vote in enumerate(row):
                table[i][1][vote] += p
                table[i][0][vote] += 1 - p
        table = [[[x / sum(seen) for x in seen] for seen in labeller] for labeller in table]
        share = (sum(found) + 1) / (len(cast) + 2)
        new = []
        for row in cast:
            odds = math.log(share / (1 - share))
            odds += sum(math.log(table[i][1][v] / table[i][0][v]) for i, v in enumerate(row))
            new.append(1 / (1 + math.exp(-max(-30, min(30, odds)))))
        done = max(abs(a - b) for a, b in zip(new, found)) < 1e-9
        if done:
            break
        found = new
    return found


def test_posteriors_of_all_documents_row_by_row(spark):
    texts = documents()
    cast = {k: votes(t) for k, t in texts.items()}
    expected = dict(zip(cast, posteriors(list(cast.values()))))
    for row in QUERIES["op1_quality"](spark, SF_DIR).collect():
        pattern = sum(v * 3**i for i, v in enumerate(cast[row.doc_id]))
        assert row.pattern == pattern
        assert abs(row.posterior - expected[row.doc_id]) < 1e-6
        assert row.predicted == (row.score >= 0.5) and 0 <= row.score <= 1


def test_posteriors_of_one_pattern_and_of_none(spark):
    """One pattern only: the labellers' prior decides, and every text gets the same."""
    rows = quality.classify(spark, frame(spark, ["same"] * 7)).collect()
    assert {r.pattern for r in rows} == {sum(v * 3**i for i, v in enumerate(votes("same")))}
    (one,) = {round(r.posterior, 6) for r in rows}
    assert abs(one - posteriors([votes("same")] * 7)[0]) < 1e-6
    assert quality.classify(spark, frame(spark, [])).collect() == []


# Toxicity: the learner with one dictionary entry a weight


def places(text):
    """Features of a text: its words, stems, pairs and pairs around a word, hashed."""
    words = [w for w in re.findall(r"\w+", (text or "").lower())]
    full = [xxhash.xxh64_intdigest(w) >> 32 for w in words]
    stem = [xxhash.xxh64_intdigest(w[:4]) >> 32 for w in words]
    mask = (1 << 64) - 1
    found = list(full)
    found += [(s << 32) + 1 for s in stem]
    found += [a * 0xC2B2AE3D27D4EB4F + b + 2 for a, b in zip(full, full[1:])]
    found += [a * 0xC2B2AE3D27D4EB4F + b + 3 for a, b in zip(full, full[2:])]
    hashed = {(x * 0x9E3779B97F4A7C15 & mask) >> 64 - toxicity.BITS for x in found}
    return sorted(hashed | {0})


def test_learner_equals_a_plain_loop(spark):
    texts, labels = toxic_corpus(150)
    known = spark.createDataFrame(labels, "doc_id int, label int")
    got = toxicity.train(spark, frame(spark, texts), known)
    rows = sorted(
        (label, np.array(places(texts[i]), "<i4").tobytes(), places(texts[i])) for i, label in labels
    )
    z, n = {}, {}

    def weight(at):
        if abs(z.get(at, 0.0)) <= toxicity.L1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n.get(at, 0.0))) / toxicity.ALPHA + toxicity.L2
        return (math.copysign(toxicity.L1, z[at]) - z[at]) / rate

    random = np.random.default_rng(7)
    for _ in range(toxicity.EPOCHS):
        for i in random.permutation(len(rows)):
            label, _, at = rows[i]
            w = [weight(a) for a in at]
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w))))) - label
            g *= toxicity.TOXIC_WEIGHT if label else 1.0
            for a, old in zip(at, w):
                seen = n.get(a, 0.0)
                z[a] = z.get(a, 0.0) + g - (math.sqrt(seen + g * g) - math.sqrt(seen)) / toxicity.ALPHA * old
                n[a] = seen + g * g
    expected = {a: w for a in z if (w := weight(a))}
    assert set(np.flatnonzero(got)) == set(expected) and len(expected) > 10
    assert all(abs(got[a] - w) < 1e-4 for a, w in expected.items())
    score = toxicity.scorer(spark, got)
    for row in frame(spark, texts).select("doc_id", score(F.col("text")).alias("s")).collect():
        total = sum(expected.get(a, 0.0) for a in places(texts[row.doc_id]))
        assert abs(row.s - 1 / (1 + math.exp(-total))) < 1e-4


# Fingerprints: a hash of the last seven bytes, byte by byte


def brute_signature(text):
    data = text.encode()
    if not data:
        return "1::"
    mask, hashes = (1 << 32) - 1, []
    for i in range(len(data)):
        h = 0
        for back in range(min(ctph.ROLLED, i + 1)):
            h += data[i - back] * pow(0x01000193, back, 1 << 32)
        h &= mask
        h ^= h >> 15
        h = h * 0x85EBCA6B & mask
        hashes.append(h ^ h >> 13)

    def ends(block):
        return [i + 1 for i, h in enumerate(hashes[:-1]) if h % block == block - 1]

    block = 1
    while block * ctph.CHUNKS < len(data):
        block *= 2
    while block > 1 and len(ends(block)) < ctph.LEAST_CHUNKS:
        block //= 2
    while len(ends(block)) > ctph.MOST_CHUNKS:
        block *= 2

    def letters(cuts):
        out = ""
        for a, b in zip([0, *cuts], [*cuts, len(data)]):
            out += chr(ctph._LETTERS[(zlib.crc32(data[a:b]) * 0x9E3779B1 & mask) >> 26])
        return out

    return f"{block}:{letters(ends(block))}:{letters(ends(2 * block))}"


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def brute_likeness(a, b):
    if a == b:
        return 1.0
    (block_a, a1, a2), (block_b, b1, b2) = a.split(":"), b.split(":")
    if not a1 or not b1:
        return 0.0
    alike = lambda x, y: 1 - distance(x, y) / max(len(x), len(y))
    block_a, block_b = int(block_a), int(block_b)
    if block_a == block_b:
        return max(alike(a1, b1), alike(a2, b2))
    if block_a == 2 * block_b:
        return alike(a1, b2)
    return alike(a2, b1) if block_b == 2 * block_a else 0.0


def test_fingerprints_of_all_documents_byte_by_byte(spark):
    """Those short enough for plain loops in full, and the likeness of every pair returned."""
    texts = documents()
    ids = sorted(texts)
    rows = {r.doc_id: r for r in QUERIES["op6_fingerprints"](spark, SF_DIR).collect()}
    assert sorted(rows) == ids
    for here, after in zip(ids, ids[1:] + ids[:1]):
        row, text = rows[here], texts[here] or ""
        n = len(text) // 4
        made = text[: len(text) - n] + (texts[after] or "")[:n]
        if len(text) < 6000:
            assert row.fingerprint == brute_signature(text)
            assert row.edited_fingerprint == brute_signature(made)
        assert abs(row.near_edited - brute_likeness(row.fingerprint, row.edited_fingerprint)) < 1e-9
        next_one = rows[after].fingerprint
        assert abs(row.near_next - brute_likeness(row.fingerprint, next_one)) < 1e-9


def test_fingerprints_of_texts_that_repeat_themselves():
    for text in ("a", "ab" * 5000, "the same line\n" * 800, "x" * 100_000, "word " * 300 + "end"):
        assert ctph.signature(text[:20_000]) == brute_signature(text[:20_000])
        assert len(ctph.signature(text).split(":")[1]) <= ctph.MOST_CHUNKS + 1


# Language: marginals by adding up every labelling of a short text


def test_marginals_add_up_all_labellings():
    random = np.random.default_rng(4)
    for n, k in ((1, 2), (4, 3), (6, 2)):
        emitted, moves = random.normal(size=(n, k)), random.normal(size=(k, k))
        expected = np.zeros((n, k))
        for labels in itertools.product(range(k), repeat=n):
            score = sum(emitted[i, y] for i, y in enumerate(labels))
            score += sum(moves[a, b] for a, b in zip(labels, labels[1:]))
            for i, y in enumerate(labels):
                expected[i, y] += math.exp(score)
        expected /= expected.sum(axis=1, keepdims=True)
        starts = np.arange(n) == 0
        assert np.allclose(langid.forward_backward(emitted, starts, moves), expected)


def test_features_are_affixes_grams_and_the_word():
    """As many as a word has, equal where words share them, whatever stands around."""
    words = ["a", "ab", "abc", "abcdef", "xbcdef", "abcdef"]
    found = langid.features(words)
    for word, row in zip(words, found):
        n = len(word)
        affixes = 2 * min(n, 3)
        assert (row > 0).sum() == affixes + max(0, n - 2) + 1
    assert (found[3] == found[5]).all()
    shared = (found[3] == found[4]) & (found[3] > 0)
    assert shared.sum() == 3 + 3  # three endings and the grams bcd, cde, def
