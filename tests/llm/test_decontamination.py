import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute
from breachline.llm import decontamination
from breachline.llm.decontamination import Budget, Index, alignment, decontaminate, find_leaks

ITEM = "which of the following rivers flows through the largest number of countries on its way"
OTHER = "name the two chemical elements that are liquid at room temperature and say why"


def changed(text, seed, n):
    pick, out = random.Random(seed), list(text)
    for _ in range(n):
        at = pick.randrange(len(out))
        out[at : at + pick.choice((0, 1))] = pick.choice(("", "x", "q"))
    return "".join(out)


ITEMS = [(1, ITEM), (2, OTHER), (3, "short"), (4, None), (None, ITEM), (5, ITEM.upper()), (1, OTHER + " twice")]
ROWS = [
    (1, f"before {ITEM} after"),
    (2, f"before\n\n{ITEM.upper().replace(' ', '   ')} after {OTHER}"),
    *[(10 + n, f"some text {changed(ITEM, n, n)} and more text") for n in range(16)],
    (40, ITEM[: len(ITEM) // 2]),
    (41, None),
    (42, ""),
    (43, "nothing to see here " * 50),
    (44, OTHER),
    (44, OTHER),
    (None, ITEM),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string")


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_equals_brute_force(spark, block):
    got = find_leaks(docs(spark), items(spark), block_chars=block).collect()
    want = brute.leaks([t for _, t in ROWS], ITEMS, Budget())
    found = [(r["doc_id"], [(x["item_id"], x["edits"]) for x in r["leaks"]]) for r in got]
    assert sorted(found, key=repr) == sorted(zip([d for d, _ in ROWS], want), key=repr)


def test_blocks_hold_every_item_once_and_are_bounded(spark):
    rows = [(i, f"item {i} " + "abcdefgh " * (i % 7)) for i in range(300)]
    blocks = [b.collect() for b in decontamination._blocks(items(spark, rows + rows), 2000)]
    assert sorted((r["item_id"], r["text"]) for b in blocks for r in b) == sorted(rows)
    total = sum(len(t) for _, t in rows)
    assert all(sum(len(r["text"]) for r in b) <= 2000 for b in blocks) and len(blocks) <= 2 * total // 2000 + 1


def test_a_worker_keeps_one_block(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(decontamination, "kept_by_worker", lambda key, make: kept.setdefault(key, make()))
    blocks = decontamination._blocks(items(spark), 60)
    assert len(blocks) > 2
    for block in blocks:
        found = decontamination._search(block, Budget(), "array<struct<item_id:bigint,edits:int>>")
        want = {r["item_id"] for r in block.collect() if len(decontamination.normal(r["text"])) >= 8}
        texts = [pd.Series([r["text"] for r in block.collect()])]
        got = {x["item_id"] for answers in found.func(iter(texts)) for a in answers for x in a}
        assert got == want
        assert [len(v) for v in kept.values()] == [1]


def test_clashing_names_and_repeats_over_several_blocks(spark):
    odd = docs(spark, ROWS + ROWS).withColumns({"_leaks": F.lit(1), "_digest": F.lit(2), "leaks": F.lit(3)})
    got = find_leaks(odd, items(spark), block_chars=60)
    assert got.columns == ["doc_id", "text", "_leaks", "_digest", "leaks"]
    assert got.count() == 2 * len(ROWS)
    one = find_leaks(docs(spark, ROWS + ROWS), items(spark))
    assert sorted(map(str, got.select("doc_id", "leaks").collect())) == sorted(
        map(str, one.select("doc_id", "leaks").collect())
    )


def test_documents_are_searched_once(spark):
    plan = decontaminate(docs(spark), items(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_random_edits_equal_brute_force():
    pick, budget = random.Random(3), Budget()
    for _ in range(150):
        item = decontamination.normal("".join(pick.choice("abcde ") for _ in range(pick.randint(8, 60))))
        if len(item) < budget.q:
            continue
        noise = ["".join(pick.choice("abcde ") for _ in range(pick.randint(0, 30))) for _ in range(2)]
        text = noise[0] + changed(item, pick.random(), pick.randint(0, 8)) + noise[1]
        assert [sorted(Index([(7, item)], budget).find(text).items())] == brute.leaks([text], [(7, item)], budget)


def test_alignment_is_semi_global():
    assert alignment("abcdef", "xxabcdefyy", 2) == 0
    assert alignment("abcdef", "xxabXdefyy", 2) == 1
    assert alignment("abcdef", "xxabdefyy", 2) == 1
    assert alignment("abcdef", "zzzzzz", 2) is None
    assert alignment("abcdef", "abc", 2) is None


def test_long_texts_are_searched_in_slices(monkeypatch):
    text = "filler words " * 100 + ITEM + " filler" * 100
    for size in (50, 300, 1297):
        monkeypatch.setattr(decontamination, "_SLICE", size)
        assert Index([(1, ITEM)], Budget()).find(text) == {1: 0}


def test_clean_documents_stay_whole(spark):
    odd = docs(spark).withColumns({"leaks": F.lit(1), "item_id": F.lit(2)})
    clean = decontaminate(odd.drop("leaks"), items(spark))
    want = [d for (d, _), x in zip(ROWS, brute.leaks([t for _, t in ROWS], ITEMS, Budget())) if not x]
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(want)
    assert clean.columns == ["doc_id", "text", "item_id"]
    assert find_leaks(odd, items(spark)).columns == ["doc_id", "text", "item_id", "leaks"]


def test_empty_tables(spark):
    assert find_leaks(docs(spark, []), items(spark)).count() == 0
    assert {len(r["leaks"]) for r in find_leaks(docs(spark), items(spark, [])).collect()} == {0}
    with pytest.raises(ValueError):
        find_leaks(docs(spark), items(spark), Budget(q=6))
