import random

import pytest
from pyspark.sql import functions as F

import brute
from breachline.llm.line_dedup import dedup_lines

LONG = "a line of quite a few words that counts alone"
SHORT = ["short one", "two words", "and three", "four", "five more", "six of them", "seven", "eight"]
ROWS = [
    (1, f"start\n{LONG}\nend"),
    (2, f"{LONG}\nother\n{LONG}"),
    (3, "\n".join(SHORT)),
    (4, "before\n" + "\n".join(SHORT) + "\nafter"),
    (5, "\n".join(SHORT[:2])),
    (6, "\n\n\n\n\n\n\n\n\n\n"),
    (7, "\n\n\n\n\n\n\n\n\n\n"),
    (8, None),
    (9, ""),
    (10, LONG),
    (11, LONG),
    (12, LONG + " "),
    (13, "\n".join([LONG] * 5)),
    (14, "\n".join(f"line {i % 3} of a text that is repeated" for i in range(40))),
    (15, "\n".join(f"line {i % 3} of a text that is repeated" for i in range(40)) + "\r\ntail"),
    (None, LONG + "\nwithout an id"),
    (0, "the words of the very first document are here\nx"),
    (None, "the words of the very first document are here\nx"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("min_words", [8, 1, 20])
def test_equals_brute_force(spark, min_words):
    got = dedup_lines(frame(spark), min_words).select("doc_id", "text").collect()
    want = zip([d for d, _ in ROWS], brute.lines(ROWS, min_words))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_on_few_kinds_of_lines(spark, seed):
    # Few kinds and short lines: runs of all lengths, of which most are settled by none of the powers.
    rng = random.Random(seed)
    kinds = ["", "a", "b b", "c", "d d d"][: 3 + seed]
    passage = [rng.choice(kinds) for _ in range(23)]
    rows = []
    for i in range(30):
        lines = [rng.choice(kinds) for _ in range(rng.randrange(1, 25))]
        if i % 3 == 0:
            first = rng.randrange(20)
            lines[5:5] = passage[first : first + rng.randrange(1, 23)]
        rows.append((i, "\n".join(lines)))
    got = dedup_lines(frame(spark, rows).repartition(3)).collect()
    want = brute.lines(rows)
    assert {r["doc_id"]: r["text"] for r in got} == {d: t for (d, _), t in zip(rows, want)}


def test_sparse_runs_go_whole(spark):
    three = "one two three\nfour five six\nseven eight nine"
    sparse = "\n".join(f"word{i}\n" for i in range(50))
    rows = [(1, f"a\n{three}\nb"), (2, f"c\n{three}\nd"), (3, f"e\n{sparse}\nf"), (4, f"g\n{sparse}\nh")]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(frame(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "c\nd", 3: rows[2][1], 4: "g\nh"}


def test_runs_that_adjoin_are_not_one(spark):
    # Both halves occur earlier, but apart, and neither has eight words.
    rows = [(1, "a a a a\nx"), (2, "b b b b b\ny"), (3, "z\na a a a\nb b b b b\nz z")]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(frame(spark, rows)).collect()}
    assert got == dict(rows)


def test_equal_rows_lose_all_but_one(spark):
    got = [r["text"] for r in dedup_lines(frame(spark, [(1, LONG)] * 3)).collect()]
    assert sorted(got) == ["", "", LONG]


def test_runs_are_maximal(spark):
    rows = [(1, "\n".join(SHORT * 2)), (2, "x\n" + "\n".join(SHORT * 2) + "\ny")]
    got = {r["doc_id"]: r["deleted_runs"] for r in dedup_lines(frame(spark, rows)).collect()}
    assert [(r["s"], r["e"]) for r in got[2]] == [(1, 17)]
    assert [(r["s"], r["e"]) for r in got[1]] == [(8, 16)]


def test_other_columns_stay_whatever_their_names(spark):
    odd = frame(spark).withColumns(
        {n: F.lit(n) for n in ("_row", "_lines", "_at", "deleted_runs", "_kept_0", "a.b")}
    )
    got = dedup_lines(odd)
    assert got.columns == ["doc_id", "text", "_row", "_lines", "_at", "_kept_0", "a.b", "deleted_runs"]
    assert {(r["_row"], r["_lines"], r["_at"]) for r in got.collect()} == {("_row", "_lines", "_at")}


def test_very_long_text(spark):
    text = "\n".join(f"number {i} of many lines in one very long document" for i in range(20_000))
    got = {r["doc_id"]: r["text"] for r in dedup_lines(frame(spark, [(1, text), (2, text + "\nend")])).collect()}
    assert got == {1: text, 2: "end"}


def test_empty_table(spark):
    assert dedup_lines(frame(spark, [])).count() == 0


def test_no_python_runs(spark):
    plan = dedup_lines(frame(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
