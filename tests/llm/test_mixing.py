import math

import pytest
from pyspark.sql import functions as F

from breachline.llm.mixing import mix, source_targets, training_order

ROWS = [
    *[(i, "w " * (i % 17), ("a", "b", "c", "d")[min(3, i % 9)]) for i in range(200)],
    (300, None, "a"),
    (301, "", "b"),
    (302, "word joined", "c"),
    (303, "x " * 3000, "tiny"),
    (304, "no source at all", None),
    (None, "no id at all", "a"),
    (305, "twice the same", "a"),
    (305, "twice the same", "a"),
    (306, "", "empty"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def filled(sizes, weights, share, most):
    """Targets by going round: cap, share the excess, again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        left = budget - sum(target.values())
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        target.update({s: most * sizes[s] for s in over})
        open_ -= over
    return target


def test_targets_equal_the_rounds(spark):
    sizes = {"a": 100, "b": 4000, "c": 30, "d": 900, "e": 0, None: 77}
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(table, (3, 1, 2), 1.5, 2).collect()}
    want = filled(sizes, (3, 1, 2), 1.5, 2)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


def test_plan_meets_targets_within_bounds(spark):
    rows = mix(frame(spark)).collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == sum(p["words"] for p in r["passes"])
        assert all(0 <= p["position"] <= 1 and p["words"] > 0 for p in r["passes"])
        by.setdefault(r["source"], []).append(r)
    for own in by.values():
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
    assert math.isclose(
        sum(own[0]["target"] for own in by.values()), 1.5 * sum(r["size"] for r in rows)
    )


def test_reruns_agree(spark):
    once = sorted(map(repr, mix(frame(spark)).collect()))
    assert once == sorted(map(repr, mix(frame(spark).repartition(7)).collect()))


def test_schedule_moves_sources_in_time(spark):
    rows = [(i, "w " * 10, s) for s in ("a", "b", "c") for i in range(1000)]
    due = training_order(mix(frame(spark, rows), weights=(1, 1, 1)))
    early = {
        r["source"]: r["share"]
        for r in due.groupBy("source").agg(F.avg((F.col("position") < 0.5).cast("int")).alias("share")).collect()
    }
    # A weight falling from 1.5 to 0.5 has 5/8 of its integral in the first half.
    assert abs(early["a"] - 0.625) < 0.01 and abs(early["b"] - 0.375) < 0.01 and abs(early["c"] - 0.5) < 0.01
    positions = [r["position"] for r in due.collect()]
    assert positions == sorted(positions)


def test_carried_columns_may_have_any_name(spark):
    odd = frame(spark).withColumns({"size": F.lit("s"), "passes": F.lit("p"), "_order": F.lit("o")})
    got = mix(odd, carry=["size", "passes", "_order"])
    assert {tuple(r["carried"]) for r in got.collect()} == {("s", "p", "o")}


def test_empty_table_and_no_words(spark):
    assert mix(frame(spark, [])).count() == 0
    rows = mix(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2


def test_bad_settings(spark):
    with pytest.raises(ValueError):
        mix(frame(spark), schedules=((1.0, 2.0),))
    with pytest.raises(ValueError):
        mix(frame(spark), total_share=3.0)
