import pytest
from pyspark.sql import functions as F

from breachline.llm.shared import components, hide, shared_folder, stage, word_count

PATH = [(i, i + 1) for i in range(40)]
STAR = [(100, i) for i in range(50, 100)]
RING = [(200 + i, 200 + (i + 1) % 7) for i in range(7)]


@pytest.mark.parametrize(
    "edges", [PATH, STAR, RING, PATH + STAR + RING, [(5, 5)], [], [(1, 2), (2, 1), (1, 2), (-3, 2)]]
)
def test_components(spark, edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert got == {n: root(n) for n in list(parent)}


def test_stage_goes_to_the_shared_folder(spark):
    frame = stage(spark.range(5))
    assert frame.count() == 5
    assert all(shared_folder(spark) in f for f in frame.inputFiles())


def test_words_are_cut_at_ascii_white_space_only(spark):
    rows = [("a b\tc\n\x0b\x0c\rd",), ("a\xa0b c",), ("",), (None,), ("  ",)]
    frame = spark.createDataFrame(rows, "text string")
    assert [r[0] for r in frame.select(word_count(F.col("text"))).collect()] == [4, 1, 0, 0, 0]


def test_hidden_columns_come_back(spark):
    frame = spark.sql("SELECT 1 AS `a.b`, 2 AS _kept_0, 3 AS text, 4 AS gone")
    carried, restored = hide(frame, ("text",), ("gone",))
    back = frame.select(*carried, F.lit(9).alias("_row")).select(*restored.values())
    assert back.columns == ["a.b", "_kept_0", "text"]
    assert tuple(back.first()) == (1, 2, 3)
