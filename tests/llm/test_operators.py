"""Every operator on small frames: brute force, and rows that are odd in some way."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import xxhash
from helpers import plan
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farelake.llm import (
    bpe,
    ctph,
    decontaminate,
    html,
    langid,
    linededup,
    quality,
    secrets,
    simhash,
    toxicity,
)
from farelake.llm.components import components

DOCS = "doc_id bigint, text string, row string, k_id string, n_words string"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, texts, ids=None, schema=DOCS):
    """Documents with extra columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "r", "k", "n") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, schema)


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join("w" + str(r.randrange(words)) for _ in range(n))


ODD = [None, "", " ", "\n\n", "a", "É", "x" * 200_000, "same words here", "same words here"]


# Decontamination


def brute_hits(text, items):
    """Words and hit words of a text, and ids of items with windows in it."""
    words = lambda t: re.findall(decontaminate.WORD, lowered(t or ""))
    doc, hit, ids = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            for at in range(len(doc) - n + 1):
                if doc[at : at + n] == w[s : s + n]:
                    hit.update(range(at, at + n))
                    ids.add(item)
    return len(doc), len(hit), ids


def lowered(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


ITEMS = [
    (1, prose(1, 40)),
    (2, prose(2, 13)),
    (3, "Short Item here"),
    (4, "one"),
    (5, prose(1, 40)[5:]),
    (6, None),
    (7, "..."),
    (8, prose(2, 13)),
]


def test_decontamination_equals_brute_force(spark):
    first, second = ITEMS[0][1], ITEMS[1][1]
    texts = [
        *ODD,
        f"before {first} after",
        f"{prose(9, 300)} {' '.join(first.split()[3:20])} {prose(10, 300)}",
        " ".join(second.upper().split()[:12]),
        f"{second} {second} short-item, HERE!",
        " ".join([second] * 30) + " one",
        "the one",
        " ".join(first.split()[:13] + first.split()[4:30]),
    ]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.report(spark, frame(spark, texts), items).collect()
    assert len(got) == len(texts)
    for row in got:
        n, hit, ids = brute_hits(texts[row.doc_id], [(i, t) for i, t in ITEMS])
        listed = ",".join(sorted(map(str, ids)))
        assert (row.n_words, row.n_hit, row.n_items) == (n, hit, len(ids)), row
        assert row.items_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.contaminated == (hit > 0 and 20 * hit >= n)


def test_decontamination_by_exchange_equals_broadcast(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = frame(spark, [f"x {ITEMS[0][1]}", ITEMS[1][1], None])
    expected = sorted(map(tuple, decontaminate.report(spark, docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontaminate.report(spark, docs, items).collect())) == expected


def test_decontamination_moves_no_words_of_documents(spark, monkeypatch, capsys):
    """However many shingles the items have, no exchange carries the words of a text."""
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = frame(spark, [f"x {ITEMS[0][1]}", ITEMS[1][1], None])
    written = []
    write = DataFrameWriter.parquet

    def noted(self, path, *args, **more):
        written.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 20)
    expected = {k: brute_hits(t, ITEMS)[1] for k, t in enumerate([f"x {ITEMS[0][1]}", ITEMS[1][1], None])}
    rows = decontaminate.report(spark, docs, items).collect()
    assert {r.doc_id: r.n_hit for r in rows} == expected
    hits = [plan for plan in written if "near" in plan]
    assert len(hits) > 2
    for plan in hits:
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert not any("w#" in line or "near#" in line for line in exchanges)


def test_decontamination_of_odd_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    none = items.limit(0)
    docs = frame(spark, [ITEMS[0][1]] * 3 + [None], [None, 7, 7, None])
    rows = decontaminate.report(spark, docs, items).collect()
    assert sorted(r.n_hit for r in rows) == [0, 40, 40, 40]
    assert [r.n_hit for r in decontaminate.report(spark, docs, none).collect()] == [0] * 4
    assert decontaminate.report(spark, docs.limit(0), items).count() == 0
    kept = decontaminate.without_contaminated(spark, docs, items)
    assert kept.columns == docs.columns and kept.count() == 1


# Byte-pair encoding


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(VOCABULARY)


def test_bpe_equals_the_library(spark, codec):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    r = random.Random(3)
    letters = "aé́ßあ \n\t'’12٣!?<|>\U0001f600‍IT's"
    texts = [*ODD[1:], "<|endoftext|>x<|endoftext|>", "it's  THEY'LL  \n\n x", "  ", "\x00\x7f"]
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(300)]
    rows = frame(spark, texts).select("text", bpe.coded(VOCABULARY)("text").alias("m")).collect()
    for row in rows:
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids
        assert row.m.ids == ids and row.m.n_tokens == len(ids)
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert row.m.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert codec.decode(ids) == row.text
    null = frame(spark, [None]).select(bpe.encoded(VOCABULARY)("text").alias("ids"))
    assert null.select("ids", bpe.decoded(VOCABULARY)("ids")).first() == ([], "")


def test_bpe_boundaries_are_in_no_token(codec):
    for token in list(codec.token.values())[:5000]:
        if token not in {s.encode() for s in codec.special}:
            assert codec.forced.isdisjoint(zip(token, token[1:]))


# Secrets


def brute_spans(text):
    text = text or ""
    base = [("assign", *m.span()) for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= 6]
    base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    added = []
    for m in re.finditer(secrets.CANDIDATE, text):
        s = m[0]
        if re.search(secrets.ALLOWED.replace("(?", "(?"), s):
            continue
        kind = "mixed"
        if re.fullmatch("[^A-Z]*", s) or re.fullmatch("[^a-z]*", s):
            kind = "single"
        if re.fullmatch("[0-9A-Fa-f]*", s):
            kind = "hex"
        most = secrets.most_weight(secrets.LEAST_BITS[kind])
        w = secrets.WINDOW
        high = [
            i
            for i in range(len(s) - w + 1)
            if sum(secrets.weight(s[i : i + w].count(c)) for c in set(s[i : i + w])) <= most
        ]
        if high:
            a, b = m.start() + high[0], m.start() + high[-1] + w
            if not any(x <= a and b <= y for _, x, y in base):
                added.append(("entropy", a, b))
    order = {k: i for i, k in enumerate(secrets.KINDS)}
    key = lambda s: (s[1], order[s[0]])
    return sorted(base, key=key), sorted(base + added, key=key)


def test_secrets_equal_brute_force(spark):
    r = random.Random(4)
    any_of = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [
        *ODD,
        "token=token:abcdefgh password = 'abc' Secret: \"abc.def-1\" API_KEY=x_y/z+1",
        "é" * 10 + "AKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 13 + " AKIA" + "C" * 15,
        "deadbeef" * 4 + " " + "0f" * 11 + " É " + "0123456789abcdef" * 2,
        f"key {any_of(b64, 40)} and {any_of(b64, 200)}",
        f"{any_of('0123456789abcdefghijklmnopqrstuvwxyz', 60)} {any_of('0123456789ABCDEF', 64)}",
        "aaaaaaaaaa1aaaaaaaaaa" + any_of(b64, 30) + "1" * 40,
        "550e8400-e29b-41d4-a716-446655440000 0123456789012345678901234567890",
        "x" * 5000 + any_of(b64, 3000) + " " + any_of(b64, 20),
        "tOkEn:" + "a" * 5 + " ſecret=abcdefgh toKen=abcdefgh",
    ]
    texts += [any_of(b64[:30] + "\"'=: \n" + "token", 300) for _ in range(20)]
    for row in secrets.scan(frame(spark, texts)).collect():
        base, spans = brute_spans(texts[row.doc_id])
        got = lambda x: [(secrets.KINDS[s.kind], s.start, s.end) for s in x]
        assert got(row.base) == base and got(row.spans) == spans, texts[row.doc_id][:80]
    assert any(s[0] == "entropy" for t in texts for s in brute_spans(t)[1])
    assert secrets.report(frame(spark, []), "doc_id", "text").count() == 0


def test_secrets_of_a_text_with_many_matches(spark):
    """Spans of every kind in a text of 50,000 matches; the time follows their number."""
    parts = ["AKIA%016d", "token=abc%06d", "%024x", "w%d wörter"]

    def seconds(n):
        text = " ".join(parts[i % 4] % i for i in range(n))
        begun = time.monotonic()
        (row,) = secrets.scan(frame(spark, [text])).collect()
        got = [(secrets.KINDS[s.kind], s.start, s.end) for s in row.spans]
        base = [(k, *m.span()) for k, p in BASE for m in re.finditer(p, text)]
        assert [s for s in got if s[0] != "entropy"] == sorted(base, key=lambda s: s[1])
        assert len(base) == 3 * n // 4
        return time.monotonic() - begun

    seconds(100)
    few, many = seconds(12_500), seconds(50_000)
    assert many < 10 * few


BASE = [("assign", secrets.ASSIGN), ("access", secrets.ACCESS), ("hex", secrets.HEX)]


def test_secrets_run_no_python(spark):
    plan = secrets.report(frame(spark, ["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# Toxicity


def toxic_corpus(n):
    r = random.Random(8)
    texts, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words[r.randrange(60)] = r.choice(["moron", "scummy", "scumbag"])
        texts.append(" ".join(words))
        labels.append((i, int(toxic)))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = toxic_corpus(600)
    docs = frame(spark, texts)
    known = spark.createDataFrame(labels[:400] + [(None, 1), (3, None)], "doc_id int, label int")
    score = toxicity.scorer(spark, toxicity.train(spark, docs, known))
    rows = docs.where("doc_id >= 400").select("doc_id", score(F.col("text")).alias("s")).collect()
    wrong = [r for r in rows if (r.s >= toxicity.THRESHOLD) != (r.doc_id % 5 == 0)]
    assert len(rows) == 200 and len(wrong) <= 4
    odd = frame(spark, ODD).select("text", score(F.col("text")).alias("s")).collect()
    assert all(0 <= r.s < 0.7 for r in odd) and odd[-1].s == odd[-2].s


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id int, label int")
    score = toxicity.scorer(spark, toxicity.train(spark, frame(spark, ["a"]), none))
    assert frame(spark, ODD).where(score(F.col("text")) != 0.5).count() == 0


# Piecewise fingerprints


def test_fingerprints_follow_the_next_document(spark):
    r = random.Random(2)
    ids = [None, *r.sample(range(-50, 1000), 120)]
    texts = [prose(i, r.randrange(300)) for i in range(119)] + [None, ""]
    got = {x.doc_id: x for x in ctph.edit_report(spark, frame(spark, texts, ids)).collect()}
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0))
    assert len(got) == len(ids)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        row = got[i]
        assert row.n_chars == len(text) and row.fingerprint == ctph.signature(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.edited_fingerprint == ctph.signature(edited)
    long = [x for x in got.values() if x.n_chars > 300]
    assert min(x.near_edited for x in long) > 0.4 and max(x.near_next for x in long) < 0.4


def test_fingerprints_of_odd_rows(spark):
    rows = ctph.edit_report(spark, frame(spark, ODD, [5, 5, 5, None, None, 1, 2, 3, 3])).collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert ctph.edit_report(spark, frame(spark, [])).count() == 0
    one = ctph.edit_report(spark, frame(spark, ["abcdefgh"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1


def test_boundaries_come_back_after_an_insertion():
    text = prose(1, 2000)
    assert len(ctph.signature("zz" + text).split(":")[1]) > 20
    same = ctph.signature(text).split(":")[1][5:-1]
    assert same in ctph.signature("Zz " + text).split(":")[1]


# Main text


PAGE = (
    "<!doctype html><html><head><title>T</title><style>p{}</style><script>var a='<p>x</p>'"
    "</script></head><body><nav><a>Menu</a></nav><div class='cookie-notice'>We use cookies</div>"
    "<header>Site</header><main><h1>Title &amp; more</h1><p>One <b>bold</b>ly\n\n two&nbsp;three<br>four"
    "<p>Next<ul><li>a<li>b</ul><aside>See also</aside><form>Mail</form><div id=comments><p>Nice!"
    "</div><!-- <p>no</p> --><p>End</main><footer>&copy; x</footer></body></html>"
)


def test_main_text_of_marked_articles(spark):
    urls = ["http://a.example/1", None, "http://[bad", "HTTP://A.example/2"]
    pages = spark.createDataFrame(
        [(i, u, PAGE) for i, u in enumerate(urls)] + [(9, "http://a", None), (9, "http://a", "")],
        "page_id int, url string, html string",
    )
    rows = html.main_text(spark, pages).collect()
    expected = "Title & more One boldly two three four Next a b End"
    assert sorted((r.page_id, r.text) for r in rows) == [(i, expected) for i in range(4)] + [
        (9, ""),
        (9, ""),
    ]
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html.main_text(spark, pages.limit(0)).count() == 0


def test_main_text_of_open_pages_drops_what_a_host_repeats(spark):
    def page(i):
        chrome = "<div>All rights reserved by this fine house</div><div>since 1900</div>"
        return f"<body><div>Welcome dear reader to our daily paper</div><p>Story {prose(i, 30)}</p>{chrome}"

    pages = [(i, f"http://h{i % 2}.example/{i}", page(i)) for i in range(6)]
    pages.append((7, "http://lonely.example", page(7)))
    rows = html.main_text(
        spark, spark.createDataFrame(pages, "page_id int, url string, html string")
    ).collect()
    for r in rows:
        story = f"Story {prose(r.page_id, 30)}"
        if r.page_id == 7:
            assert r.text.startswith("Welcome") and r.text.endswith("since 1900")
        else:
            # "since 1900" is part of a longer run that repeats.
            assert r.text == story


def test_articles_come_before_what_is_marked_as_main(spark):
    page = "<main><p>Teaser</p><article><header><h1>H</h1></header><p>A</p></article></main>"
    row = [(1, "http://a", page), (2, "http://a", "<div role=main><p>B</div><p>C")]
    pages = spark.createDataFrame(row, "page_id int, url string, html string")
    assert [r.text for r in html.main_text(spark, pages).orderBy("page_id").collect()] == ["H A", "B"]


def test_broken_markup():
    text = lambda h: " ".join(t for t, z in html.blocks_of(h) if z != html.AWAY)
    assert text("a < b &am <p>c</p></div></p> d <!-- x") == "a < b &am c d"
    assert text("<p>x<script>if (a<b) '</p>'") == "x"
    assert text("<p hidden>x</p><p style='display: none'>y</p>z") == "z"
    assert text('<p title="a>b">x</p><img alt="<p>">y') == "x y"
    assert text("<p title=don't>x</p> it's") == "x it's"
    assert text("<a " * 50_000 + '="') == ""
    assert text('<div class="siteNotice">x</div><div id="ad-12">y</div><i data-id="ad">z</i>') == "z"
    assert text("<" * 50_000) == "<" * 50_000
    assert text("<p>" * 20_000 + "x") == "x"


# Line dedup


def brute_lines(docs, more_than):
    """Kept texts: every run of lines with an earlier copy is deleted."""
    lines = {k: t.split("\n") for k, t in docs}
    first, gone = {}, set()
    runs = []
    for k in sorted(lines):
        for a in range(len(lines[k])):
            for b in range(a + 1, len(lines[k]) + 1):
                run = tuple(lines[k][a:b])
                if sum(len(x.split()) for x in run) > more_than:
                    first.setdefault(run, (k, a))
                    runs.append((k, a, b, run))
    for k, a, b, run in runs:
        if (k, a) > first[run]:
            gone.update((k, i) for i in range(a, b))
    return {k: "\n".join(x for i, x in enumerate(lines[k]) if (k, i) not in gone) for k in lines}


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(6)
    pool = [prose(i, n) for i, n in enumerate([1, 2, 3, 5, 8, 13, 30, 49, 50, 51, 60, 120])] + [""]
    texts = ["\n".join(r.choice(pool) for _ in range(r.randrange(1, 14))) for _ in range(60)]
    texts += texts[:5] + ["\n".join([pool[3]] * 40)]
    kept = linededup.without_repeated_lines(spark, frame(spark, texts))
    assert kept.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ")
    expected = brute_lines(list(enumerate(texts)), 50)
    assert {x.doc_id: x.text for x in kept.collect()} == expected


def test_line_dedup_of_odd_rows(spark):
    long = prose(1, 60)
    texts = [*ODD, long, long, long, f"a\n{long}\nb"]
    ids = [9, 8, 7, None, None, 5, 4, 3, 3, 11, 11, None, 12]
    rows = linededup.line_dedup(spark, frame(spark, texts, ids)).select("row.doc_id", "cut.*")
    got = [(x.doc_id, x.text) for x in rows.collect()]
    assert len(got) == len(texts) and (9, None) in got and (8, "") in got
    # The null id comes first and keeps its copy; 11 was read twice and is cut alike.
    assert got.count((11, "")) == 2 and (None, long) in got and (12, "a\nb") in got
    assert linededup.without_repeated_lines(spark, frame(spark, [])).count() == 0


# Language


def test_language_of_texts_and_of_mixed_texts(spark):
    words = {"aa": ["kato", "mira", "solun", "teko"], "bb": ["schwul", "grunz", "blichen", "pfad"]}
    r = random.Random(1)
    say = lambda lang, n: " ".join(
        r.choice(words[lang]) + r.choice(words[lang])[:3] for _ in range(n)
    )
    rows = [(say(lang, 40), lang) for lang in words for _ in range(80)] + [("x", None), (None, "aa")]
    model = langid.train(spark, spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["aa", "bb"]
    texts = [say("aa", 30), say("bb", 30), say("aa", 40) + " " + say("bb", 12), *ODD, "12 !?", "²"]
    found = frame(spark, texts).select("doc_id", langid.predictor(spark, model)("text").alias("p"))
    got = [(x.p.lang_pred, x.p.score) for x in found.orderBy("doc_id").collect()]
    assert [g[0] for g in got[:3]] == ["aa", "bb", "aa"] and 0.6 < got[2][1] < 0.95
    assert [g[0] for g in got[3:7]] == ["und"] * 4 and got[-1] == got[-2] == ("und", 0.0)
    nothing = langid.train(spark, spark.createDataFrame([], "text string, lang string"))
    assert frame(spark, ["a b"]).select(langid.predictor(spark, nothing)("text")["lang_pred"]).first()[0] == "und"


def test_language_of_a_dirty_column_learns_the_commonest_values(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [("kato mira", "aa")] * 30 + [("schwul grunz", "bb")] * 20
    rows += [(f"noise {i}", f"x{i}") for i in range(40)]
    model = langid.train(spark, spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["aa", "bb"]


def test_language_reads_every_letter_of_scripts_without_spaces():
    """A long run of letters is words of twenty, whose features cover all of it."""
    run = "abcdefghijklmnopqrstuvwxyz" * 4
    assert langid.words_of(f"{run} Ab") == [run[i : i + 20] for i in range(0, 104, 20)] + ["ab"]
    plain = langid.features(langid.words_of(run))
    for at in (0, 30, 77, 103):
        other = langid.features(langid.words_of(run[:at] + "ß" + run[at + 1 :]))
        assert plain.shape == other.shape and (plain != other).any()


def test_forward_backward_equals_one_by_one():
    r = np.random.default_rng(0)
    lengths, k = [1, 7, 2, 40, 13], 3
    moves = r.normal(size=(k, k))
    emitted = r.normal(size=(sum(lengths), k))
    starts = np.zeros(len(emitted), bool)
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    starts[firsts] = True
    got = langid.forward_backward(emitted, starts, moves)
    for first, n in zip(firsts, lengths):
        part = emitted[first : first + n][None]
        expected, _ = langid._marginals(part, moves)
        assert np.allclose(got[first : first + n], expected[0])


# SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 2)
    shingles = [" ".join(words[i : i + 3]) for i in range(n)]
    digests = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > n)


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_groups_equal_brute_force(spark):
    r = random.Random(12)
    texts = [*ODD]
    for i in range(40):
        words = prose(i, r.choice([4, 30, 300, 900])).split()
        for _ in range(r.randrange(6)):
            texts.append(" ".join(words))
            words[r.randrange(len(words))] = "changed"
    texts += ["ÀB c d e\x0bF g"] * 3
    prints = [brute_fingerprint(t) for t in texts]
    linked = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    expected = brute_components(range(len(texts)), linked)
    docs = frame(spark, texts)
    found = simhash.near_duplicates(spark, docs).collect()
    assert len(found) == len(texts) and len(set(expected.values())) < len(texts) - 20
    for x in found:
        assert x.fp & (1 << 64) - 1 == prints[x.id] and x.component_id == expected[x.id]
    kept = simhash.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(expected.values()))


def test_simhash_links_lose_no_pair(spark):
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for fp in list(fps)[:30]:
        for bits in ([1], [1, 2], [5, 60], [7, 8, 9]):
            fps.add(fp ^ sum(1 << b for b in bits))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    got = {(x.a, x.b) for x in simhash.links(df).collect()}
    expected = {
        (a, b)
        for a in signed
        for b in signed
        if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    }
    assert got == expected and len(got) > 100


@pytest.mark.parametrize("rows", [50, 20_000])
def test_simhash_cells_are_never_broadcast(spark, capsys, rows):
    """Their size is taken for that of the fingerprints, of which each has some 30 cells."""
    fps = spark.range(rows).select(F.xxhash64("id").alias("fp"))
    found = simhash.links(fps)
    found.collect()
    nodes = plan(found, capsys)
    assert "SortMergeJoin" in nodes
    assert "Broadcast" not in nodes


def test_simhash_of_odd_rows(spark):
    docs = frame(spark, ["a b c d"] * 4 + [None, "", "q r s t"], [None, None, 3, 3, 2, None, None])
    found = simhash.near_duplicates(spark, docs).collect()
    assert sorted((x.id or -1, x.component_id or -1) for x in found) == [
        (-1, -1), (-1, 2), (-1, 3), (-1, 3), (2, 2), (3, 3), (3, 3)
    ]
    kept = sorted((x.doc_id or -1, x.text or "") for x in simhash.one_of_each(spark, docs).collect())
    assert kept == [(-1, "q r s t"), (2, ""), (3, "a b c d")]
    assert simhash.near_duplicates(spark, frame(spark, [])).count() == 0
    assert simhash.one_of_each(spark, frame(spark, [])).count() == 0


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    hub = [(1000, i) for i in range(1001, 1300)]
    links = spark.createDataFrame(chain + hub + [(-5, 3000)], "a bigint, b bigint")
    roots = {x.node: x.root for x in components(spark, links).collect()}
    assert {roots[i] for i in range(201)} == {0} and {roots[i] for i in range(1000, 1300)} == {1000}
    assert roots[3000] == -5 and len(roots) == 201 + 300 + 2


# Quality


def test_quality_learns_from_labellers_alone(spark):
    r = random.Random(3)
    good = [
        ". ".join(f"The {prose(i * 7 + j, 9)} of the and it" for j in range(8)) + "."
        for i in range(120)
    ]
    bad = ["### ".join(prose(i, 60).split()).upper() for i in range(20)]
    bad += [" ".join([f"Word{i}"] * 90) for i in range(20)]
    docs = frame(spark, good + bad + ODD)
    got = {x.doc_id: x for x in quality.classify(spark, docs).collect()}
    assert len(got) == docs.count()
    assert sum(got[i].predicted for i in range(120)) >= 118
    assert sum(got[i].predicted for i in range(120, 160)) <= 2
    last = len(good + bad + ODD) - 1
    assert got[last].score == got[last - 1].score
    assert quality.classify(spark, frame(spark, [])).count() == 0
    assert r is not None


def test_accuracies_are_found_again():
    """Votes of labellers with known accuracies give those accuracies back."""
    r = np.random.default_rng(1)
    n, k = 40_000, len(quality.LABELLERS)
    truth = r.random(n) < 0.7
    right = np.linspace(0.65, 0.95, k)
    votes = np.zeros((n, k), int)
    for i in range(k):
        correct = np.where(r.random(n) < right[i], truth, ~truth)
        votes[:, i] = np.where(correct, quality.GOOD, quality.BAD)
    codes = (votes * 3 ** np.arange(k)).sum(axis=1)
    patterns, counts = np.unique(codes, return_counts=True)
    posterior, table, share = quality.accuracies(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.02
    assert np.abs(table[:, 1, quality.GOOD] - right).max() < 0.03
    known = dict(zip(patterns, posterior))
    assert np.mean([(known[c] > 0.5) == t for c, t in zip(codes, truth)]) > 0.95
