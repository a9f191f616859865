import random

import pytest
from pyspark.sql import functions as F

import brute
from breachline.llm import simhash
from breachline.llm.shared import components

WORDS = [f"w{i}" for i in range(200)]


def prose(seed, n=60):
    return " ".join(random.Random(seed).choice(WORDS) for _ in range(n))


def near(seed, base, changes):
    words, pick = base.split(), random.Random(seed)
    for _ in range(changes):
        words[pick.randrange(len(words))] = pick.choice(WORDS)
    return " ".join(words)


BASE = prose(0)
ROWS = [
    *[(i, prose(i + 1)) for i in range(10)],
    *[(20 + i, near(i, BASE, i % 4)) for i in range(40)],
    (70, None),
    (71, ""),
    (72, " \n\t"),
    (73, "one two"),
    (74, "ONE  two"),
    (75, BASE),
    (75, BASE),
    (None, BASE),
    (None, "alone and without any id at all here"),
    (76, "İI é\xa0x " * 30),
    (77, BASE.upper()),
]


def rows_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def result(frame):
    smallest = frame.groupBy("group").agg(F.min("doc_id").alias("c"))
    printed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    joined = frame.join(smallest, "group")
    return [tuple(r) for r in joined.select("doc_id", printed, "c").collect()]


@pytest.mark.parametrize("segments", [2, 3, 5])
def test_groups_equal_brute_force(spark, segments):
    got = result(simhash.near_duplicates(rows_of(spark, ROWS), segments=segments))
    assert sorted(got, key=repr) == sorted(brute.simhash(ROWS), key=repr)


@pytest.mark.parametrize("slice_bytes", [1, 7, 50])
def test_long_texts_are_read_in_slices(monkeypatch, slice_bytes):
    monkeypatch.setattr(simhash, "_SLICE", slice_bytes)
    for _, text in ROWS:
        assert simhash.fingerprint_of(text) % (1 << 64) == brute.fingerprint(text)


@pytest.mark.parametrize("block", [5, 40, 4096])
def test_hot_buckets_are_split_without_loss(spark, block):
    pick = random.Random(3)
    prints = set()
    for _ in range(10):
        base = pick.getrandbits(64)
        for _ in range(40):
            p = base
            for _ in range(pick.randrange(8)):
                p ^= 1 << pick.randrange(64)
            prints.add(p)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    frame = rows_of(spark, [(p,) for p in prints], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.links(frame, block=block)).collect()}
    far = lambda a, b: ((prints[a] ^ prints[b]) % (1 << 64)).bit_count()
    roots = brute.components(len(prints), lambda a, b: far(a, b) <= 4)
    shared = [r for r in roots if roots.count(r) > 1]
    assert got == {p: prints[r] for p, r in zip(prints, roots) if r in shared}


def test_dense_group_gives_few_links(spark):
    prints = [(1 << i) | (1 << j) for i in range(32) for j in range(i)]
    frame = rows_of(spark, [(p,) for p in prints], "fp long")
    assert simhash.links(frame).count() < 40 * len(prints)


def test_probes_need_segments():
    with pytest.raises(ValueError):
        simhash.probes(4, 6)
    with pytest.raises(ValueError):
        simhash.probes(4, 1)


def test_one_of_each_group_stays(spark):
    frame = rows_of(spark, ROWS).withColumns({"_row": F.lit("x"), "group": F.lit(1)})
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    groups = brute.simhash(ROWS)
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in groups}
    assert kept.count() == len({c for _, _, c in groups})
    assert {r["_row"] for r in kept.collect()} == {"x"}


def test_empty_table(spark):
    none = rows_of(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_first(none).count() == 0
