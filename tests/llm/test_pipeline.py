"""The pipeline by stages, each against brute force on its own input, and its edges."""

import re

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from breachline.llm.decontamination import Budget

SF = "/root/testdata/sf0.001"
NAMES = ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing to target weights"]


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder, steps = tmp_path_factory.mktemp("stages"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        done = spark.read.parquet(f"{folder}/{k}")
        steps.append((docs, done))
        docs = done
    return [(a.orderBy("doc_id").collect(), b.collect()) for a, b in steps], steps


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES


def test_all_but_the_last_keep_the_columns(outputs):
    for before, after in outputs[1][:-1]:
        assert after.columns == before.columns


def test_language_stage_drops_what_is_rejected(outputs):
    before, after = outputs[0][0]
    assert len(after) >= 0.97 * len(before)
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}


def test_line_stage_equals_brute_force(outputs):
    before, after = outputs[0][1]
    texts = brute.lines([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"]: r["text"] for r in after} == {r["doc_id"]: t for r, t in zip(before, texts)}
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_simhash_stage_equals_brute_force(outputs):
    before, after = outputs[0][2]
    want = {c for _, _, c in brute.simhash([(r["doc_id"], r["text"]) for r in before])}
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_decontamination_stage_drops_exact_leaks_and_few_more(spark, outputs):
    before, after = outputs[0][3]
    items = [r["text"].lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    flat = [" ".join(t.split()) for t in items]
    leaking = {r["doc_id"] for r in before if any(i in " ".join(r["text"].lower().split()) for i in flat)}
    kept = {r["doc_id"] for r in after}
    assert not kept & leaking
    gone = [r for r in before if r["doc_id"] not in kept and r["doc_id"] not in leaking]
    for r in gone:
        assert brute.leaks([r["text"]], [(0, i) for i in items], Budget())[0]


def test_mixing_stage_meets_targets(outputs):
    before, after = outputs[0][4]
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in before}
    taken = {}
    for r in after:
        assert r["size"] == size[r["doc_id"]]
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["pass_words"]
    assert all(n <= 2 * size[d] for d, n in taken.items())
    sources = len({r["source"] for r in before})
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= sources


def test_run_gives_the_same_rows(spark, outputs):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, outputs[0][4][1]))


ODD = [
    (1, "the same text of more than eight words in all its lines", "en", "a", 5, 1),
    (1, "the same text of more than eight words in all its lines", "en", "a", 5, 1),
    (2, None, None, None, None, None),
    (3, "", "en", None, 0, 2),
    (None, "le chat est sur la table avec les autres chats du village", "fr", "b", 9, 3),
    (4, "word " * 30_000, "en", "b", 9, 4),
]


@pytest.mark.parametrize("rows", [ODD, []])
@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows(spark, k, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row int"
    docs = spark.createDataFrame(rows, schema).withColumns({"size": F.lit("s"), "group": F.lit("g")})
    got = corpus_pipeline.STAGES[k][1](spark, docs, SF)
    data = got.collect()
    if k < 4:
        assert got.columns == docs.columns
        assert all(r["size"] == "s" and r["group"] == "g" for r in data)
    if k == 2 and rows:
        assert sum(r["doc_id"] == 1 for r in data) == 1
    assert rows or not data


def test_rejected_documents_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.select(F.lit(-1).cast("long").alias("doc_id"), F.lit("123").alias("text"), "lang", "source", "n_chars").limit(1)
    after = corpus_pipeline.identify_language(spark, docs.union(odd), SF)
    assert after.where("doc_id = -1").count() == 0
