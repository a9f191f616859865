"""The registered queries over whole tables: against SQL, brute force or what they promise."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import brute
from breachline.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


def result(spark, name):
    return sorted((tuple(r) for r in QUERIES[name](spark, SF).collect()), key=repr)


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    assert QUERIES.items() <= names.items() and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted(map(tuple, want.project(", ".join(columns)).fetchall()), key=repr)


def test_simhash(spark, duck):
    rows = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert result(spark, "op1_simhash") == sorted(brute.simhash(rows), key=repr)


def test_suffix_dedup(spark, duck):
    rows = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert result(spark, "op2_suffix_dedup") == sorted(brute.repeats(rows, 400), key=repr)


def test_embedding_dedup(spark, duck):
    rows = duck.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    assert result(spark, "op3_embedding_dedup") == sorted(brute.embeddings(rows), key=repr)


def test_language_id(spark, duck):
    got = {r[0]: r for r in result(spark, "op5_language_id")}
    langs = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    assert got.keys() == langs.keys()
    out = [d for d, r in got.items() if r[1]]
    assert sum(got[d][2] == langs[d] for d in out) >= 0.9 * len(out)


def test_token_counts(spark, duck):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    want = [(d, len(t.encode()), n := len(library.encode(t)), n > 4096) for d, t in rows]
    assert result(spark, "op7_token_counts") == sorted(want, key=repr)


def test_decontamination_finds_all_exact_leaks(spark, duck):
    got = {(d, i): e for d, i, e in result(spark, "op8_decontamination")}
    exact = duck.sql("SELECT doc_id, item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall()
    assert set(exact) <= got.keys() and all(got[p] == 0 for p in exact)


def test_quality_agrees_with_labels(spark, duck):
    got = {r[0]: r[3] for r in result(spark, "op9_quality")}
    labels = duck.sql("SELECT doc_id, quality FROM labels").fetchall()
    assert sum(got[d] == bool(q) for d, q in labels) >= 0.9 * len(labels)


def test_html_extraction(spark, duck):
    import html
    import re

    pages = duck.sql("SELECT page_id, url, html FROM pages").fetchall()
    want = []
    for page_id, url, page in pages:
        article = page[page.index("<article>") : page.index("</article>")]
        blocks = re.split(r"</?(?:p|h1)>", article)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        text = "\n".join(x for x in lines if x)
        want.append((page_id, url, text, len(text)))
    assert result(spark, "op10_html_extraction") == sorted(want, key=repr)
