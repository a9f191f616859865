"""Merkle manifests against trees built by plain loops."""

import hashlib

import pytest
from pyspark.sql import functions as F

from breachline.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([digest("".join(rows[-1][i : i + fanout])) for i in range(0, len(rows[-1]), fanout)])
    return rows


def way(rows, i, fanout):
    out = []
    for level in rows[:-1]:
        first = i - i % fanout
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        i //= fanout
    return out


def manifest_of(rows, fanout):
    """doc_id, source, place, leaf, proof, subroot, root of every row."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        by_source[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = tree([leaf_of(r) for r in by_source[name]], fanout)
    top = tree([trees[n][-1][0] for n in names], fanout)
    return [
        (r[0], r[1], i, leaf_of(r), way(trees[n], i, fanout) + way(top, k, fanout), trees[n][-1][0], top[-1][0])
        for k, n in enumerate(names)
        for i, r in enumerate(by_source[n])
    ]


def found(spark, rows, fanout, block_levels, **more):
    made = merkle.manifest(
        spark.createDataFrame(rows, SCHEMA).repartition(3), fanout=fanout, block_levels=block_levels, **more
    )
    return [
        (r.doc_id, r.source, r.place, r.leaf, [tuple(p) for p in r.proof], r.subroot, r.root)
        for r in made.collect()
    ]


ROWS = (
    [(i, "hot", "en", i % 7, f"text {i}") for i in range(41)]
    + [(100 + i, f"s{i % 5}", None, None, None if i % 3 else "") for i in range(12)]
    + [(200, "ü", "de", 1, "Ünï\n"), (None, None, None, None, None), (300, None, "x", 2, "y")]
    # Equal rows, and one id with different rows.
    + [(5, "hot", "en", 5, "text 5"), (7, "hot", "fr", 0, "other"), (None, "hot", "en", 0, "")]
)


@pytest.mark.parametrize("fanout, block_levels", [(2, 0), (3, 1), (16, 3)])
def test_every_row_as_by_plain_loops(spark, fanout, block_levels):
    want = manifest_of(ROWS, fanout)
    assert sorted(found(spark, ROWS, fanout, block_levels), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("n", [1, 3])
def test_small_tables(spark, n):
    rows = ROWS[:n]
    assert sorted(found(spark, rows, 2, 0), key=repr) == sorted(manifest_of(rows, 2), key=repr)


def test_an_empty_table_has_no_manifest(spark):
    assert found(spark, [], 2, 0) == []


def test_proofs_tell_tampered_rows(spark):
    documents = spark.createDataFrame(ROWS, SCHEMA)
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    touched = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    seen = merkle.leaf_digest(*[F.col(c) for c in columns[:-1]], touched)
    made = merkle.manifest(documents, fanout=3, block_levels=1, carry={"seen now": seen})
    again = made.select(
        "doc_id", (merkle.folded(F.col("seen now"), F.col("proof")) == F.col("root")).alias("ok")
    )
    for row in again.collect():
        has_text = row.doc_id is not None and dict((r[0], r[4]) for r in ROWS)[row.doc_id] is not None
        assert row.ok == (not (has_text and row.doc_id % 2 == 0))


def test_clashing_and_chosen_columns(spark):
    rows = spark.createDataFrame([(1, "a", 2, 3), (2, "a", 2, 3)], "doc_id int, source string, leaf int, _at int")
    made = merkle.manifest(rows, columns=("doc_id", "leaf"), fanout=2).orderBy("doc_id").collect()
    assert [r.leaf for r in made] == [digest("1:11:2"), digest("1:21:2")]
    assert {r.root for r in made} == {digest(made[0].leaf + made[1].leaf)}


def test_the_same_whatever_the_layout(spark):
    one = found(spark, ROWS, 3, 1)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        other = found(spark, ROWS[::-1], 3, 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(one, key=repr) == sorted(other, key=repr)


def test_names_that_clash_with_results_are_refused(spark):
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame(ROWS, SCHEMA), carry={"root": F.lit(1)})
