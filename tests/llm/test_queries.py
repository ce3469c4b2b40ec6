"""The registered queries over the given tables: SQL, brute force and held-out accuracy."""

from __future__ import annotations

import os
import zlib

import pytest
from oracle_compare import connect, differences
from test_operators import VOCABULARY, brute_components, brute_fingerprint, brute_hits, brute_lines
from tokenizers import Tokenizer

import corpus_pipeline
from farelake.llm.html import ARTICLE, blocks_of
from farelake.llm.oracle import ORACLE_SQL
from farelake.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def test_there_is_a_query_for_every_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE_SQL) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) == []


def test_ids_equal_the_library(spark, texts):
    import hashlib

    tokenizer = Tokenizer.from_file(VOCABULARY)
    for row in QUERIES["op3_bpe"](spark, SF_DIR).collect():
        ids = tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def groups(texts):
    """Component of every document by comparing all pairs of fingerprints."""
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    linked = [
        (a, b)
        for a in prints
        for b in prints
        if a < b and (prints[a] ^ prints[b]).bit_count() <= 2
    ]
    return prints, brute_components(prints, linked)


def test_near_duplicates_equal_brute_force(spark, texts):
    prints, roots = groups(texts)
    rows = QUERIES["op10_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        k: (f"{prints[k]:016x}", roots[k]) for k in texts
    }


def labels_of(sf_dir, column):
    rows = connect(sf_dir).execute(f"SELECT doc_id, {column} FROM labels").fetchall()
    return {k: v for k, v in rows if v is not None}


def test_toxicity_held_out(spark):
    known = labels_of(LARGER, "toxic")
    rows = QUERIES["op5_toxicity"](spark, LARGER).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    # 33 toxic rows to learn from: half of the others are found, and no clean one is hit.
    assert sum(p for p, y in held if y) >= 8 and sum(p for p, y in held if not y) == 0


def test_language_held_out(spark):
    langs = dict(connect(LARGER).execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op9_language"](spark, LARGER).collect()
    assert len(rows) == 1000
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.99 * len(held)


def test_quality_against_labels_it_has_not_seen(spark):
    known = labels_of(LARGER, "quality")
    rows = QUERIES["op1_quality"](spark, LARGER).collect()
    good = [r.predicted for r in rows if known.get(r.doc_id) == 1]
    bad = [r.predicted for r in rows if known.get(r.doc_id) == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.12 * len(bad)


def test_fingerprints_tell_edited_from_other_texts(spark):
    rows = [r for r in QUERIES["op6_fingerprints"](spark, LARGER).collect() if r.n_chars > 100]
    assert sum(r.near_edited > 0.5 > r.near_next for r in rows) >= 0.98 * len(rows)


def test_main_text_is_the_article(spark):
    pages = connect(SF_DIR).execute("SELECT page_id, html FROM pages").fetchall()
    expected = {k: " ".join(t for t, z in blocks_of(h) if z == ARTICLE) for k, h in pages}
    rows = QUERIES["op7_main_text"](spark, SF_DIR).collect()
    assert {r.page_id: r.text for r in rows} == expected and all(r.n_chars for r in rows)


def test_pipeline_stage_by_stage(spark, con, texts):
    """Each stage against brute force on what its predecessor kept."""
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns

    def step(name, docs):
        out = stages[name](spark, docs, SF_DIR)
        assert out.columns == columns
        return out, {r.doc_id: r.text for r in out.collect()}

    clean, kept = step("toxicity", docs)
    known = labels_of(SF_DIR, "toxic")
    assert all(not known.get(k) or zlib.crc32(str(k).encode()) % 3 == 1 for k in kept)
    assert all(k in kept for k in texts if known.get(k) == 0)
    cut, left = step("line dedup", clean)
    assert left == brute_lines(list(kept.items()), 50)
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    single, ones = step("near dedup", cut)
    assert set(ones) == set(groups(left)[1].values())
    pure, last = step("decontamination", single)
    for k, text in ones.items():
        n, hit, _ = brute_hits(text, items)
        assert (k in last) == (not (hit > 0 and 20 * hit >= n))
    ids = stages["bpe"](spark, pure, SF_DIR)
    assert {r.doc_id for r in ids.select("doc_id").collect()} == set(last)
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert whole.columns == ids.columns and whole.count() == len(last)


def test_stages_take_odd_rows_and_empty_tables(spark):
    """Nulls in every column, repeated rows, long texts, clashing and extra columns."""
    long = "word " * 60_000
    texts = [None, "", "a", "same", "same", long, "É\n" * 3, "x " * 200_000]
    rows = [(i % 5 or None, t, None, None, None, "extra", "extra", "extra") for i, t in enumerate(texts)]
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "row string, k_id string, fp string"
    )
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == columns, name
            assert docs.count() <= n
        coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
        # Null and "" are one group; the two rows of "same" are another.
        assert len(coded) == (6 if n else 0)
