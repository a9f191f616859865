import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from breachline.llm import suffix_dedup

PICK = random.Random(2)
BASE = "".join(PICK.choice("abcdé ") for _ in range(300))
ROWS = [
    (1, BASE),
    (1, BASE),
    (2, BASE[50:200] + "X"),
    (3, None),
    (4, ""),
    (None, BASE[10:90]),
    (None, BASE[100:140] + BASE[100:140]),
    (5, "a" * 200),
    (6, "a" * 31),
    (7, "ab" * 100),
    (8, BASE[250:] + BASE[:50]),
    *[(100 + i, BASE[20:60] + str(i) * 40) for i in range(30)],
    *[(200 + i, str(i) * 40 + BASE[20:80]) for i in range(30)],
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string")


def result(rows):
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    return [
        tuple(r)
        for r in rows.select("doc_id", size, "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    ]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text("ab", max_size=40) | st.binary(max_size=20).map(bytes.hex), min_size=1, max_size=6),
    st.integers(1, 12),
)
def test_index_equals_counting(texts, length):
    pieces = [t.encode() for t in texts] + [texts[0].encode() + b"z"]
    strings = [p[i : i + length] for p in pieces for i in range(len(p) - length + 1)]
    want = [
        [i for i in range(len(p) - length + 1) if strings.count(p[i : i + length]) > 1]
        for p in pieces
    ]
    symbols = [suffix_dedup.symbols(p) for p in pieces]
    assert [list(map(int, x)) for x in suffix_dedup.repeated_starts(symbols, length)] == want


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=90), st.text("abc", max_size=90), st.sampled_from([8, 9, 16, 30]))
def test_pieces_hold_each_string_once_and_agree(left, right, length):
    owners = {}
    for text in (left.encode(), right.encode()):
        starts = []
        for anchor, _, at, n, place in suffix_dedup.pieces_of(text, length):
            assert n - 1 <= place < length
            for s in range(at, at + n):
                starts.append(s)
                assert owners.setdefault(text[s : s + length], anchor) == anchor
        assert starts == list(range(len(text) - length + 1))


def test_long_texts_are_cut_in_slices(monkeypatch):
    text = BASE.encode()
    whole = [(a, s) for a, _, at, n, _ in suffix_dedup.pieces_of(text, 32) for s in range(at, at + n)]
    monkeypatch.setattr(suffix_dedup, "_SLICE", 10)
    cut = [(a, s) for a, _, at, n, _ in suffix_dedup.pieces_of(text, 32) for s in range(at, at + n)]
    assert cut == whole


@pytest.mark.parametrize("crowd", [256, 5, 1])
def test_equals_brute_force(spark, crowd):
    got = result(suffix_dedup.remove_repeats(frame(spark), 32, crowd))
    assert sorted(got, key=repr) == sorted(brute.repeats(ROWS, 32), key=repr)


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_INDEX", 1)
    got = result(suffix_dedup.remove_repeats(frame(spark), 32))
    assert sorted(got, key=repr) == sorted(brute.repeats(ROWS, 32), key=repr)


def test_other_columns_stay_whatever_their_names(spark):
    odd = frame(spark).withColumns({n: F.lit(n) for n in ("_id", "_text", "starts", "kept", "_body")})
    got = suffix_dedup.remove_repeats(odd, 32)
    assert got.columns == ["doc_id", "text", "_id", "_text", "starts", "_body", "kept", "n_removed", "n_spans"]
    assert {(r["_id"], r["starts"]) for r in got.collect()} == {("_id", "starts")}


def test_empty_table_and_no_repeats(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    rows = [(1, "x" * 10), (2, None)]
    assert sorted(result(suffix_dedup.remove_repeats(frame(spark, rows)))) == sorted(brute.repeats(rows, 400))


def test_hot_keys_are_dealt_and_nothing_is_lost(spark):
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), F.col("id").alias("at")
    )
    counts = rows.groupBy("key").agg(F.count("*").alias("many"))
    table = counts.where("key % 2 <> 0").select("key", F.lit("x").alias("value"))
    joined = suffix_dedup._spread_join(rows, table, ["key"], counts, 9_000)
    assert joined.columns == ["key", "at", "value"]
    got = sorted(map(tuple, joined.collect()))
    assert got == sorted(map(tuple, rows.join(table, "key").collect()))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan.split("Join Inner", 1)[1].splitlines()[0]


def test_ids_that_are_no_numbers(spark):
    named = [(f"doc-{i}", t) for i, (_, t) in enumerate(ROWS)] + [(None, BASE[:60])]
    rows = spark.createDataFrame(named, "doc_id string, text string")
    assert sorted(result(suffix_dedup.remove_repeats(rows, 32)), key=repr) == sorted(brute.repeats(named, 32), key=repr)
