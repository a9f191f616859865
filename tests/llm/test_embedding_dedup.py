import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from breachline.llm import embedding_dedup
from breachline.llm.embedding_dedup import Graph, audited, near_embeddings

SCHEMA = "vec_id long, embedding array<double>, label int"


def vectors(seed, n, groups, spread=0.25, size=8):
    pick = np.random.default_rng(seed)
    base = pick.normal(size=(groups, size))
    return base[pick.integers(groups, size=n)] + pick.normal(size=(n, size)) * spread


def rows():
    some = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors(1, 150, 12))]
    return some + [
        (200, some[0][1], some[0][2]),
        (201, some[0][1], some[0][2]),
        (201, some[0][1], some[0][2]),
        (202, None, 1),
        (203, [0.0] * 8, 1),
        (204, [float("nan")] * 8, 1),
        (205, [1.0, None], 1),
        (206, some[3][1], None),
        (207, [], 1),
        (None, some[5][1], some[5][2]),
        (208, [1e-300] * 8, 1),
        (209, [1e300] * 8, 1),
        (210, [-0.0] + [1.0] * 7, 2),
        (211, [0.0] + [1.0] * 7, 2),
        (212, [1.0, 2.0], 1),
        (213, [1.0, 2.0], 1),
        (214, [float("inf")] * 8, 1),
    ]


@pytest.mark.parametrize("shard", [16_384, 20])
def test_equals_brute_force(spark, shard):
    frame = spark.createDataFrame(rows(), SCHEMA)
    got = [tuple(r) for r in near_embeddings(frame, shard=shard, goal=1.0).collect()]
    assert sorted(got, key=repr) == sorted(brute.embeddings(rows()), key=repr)


def test_other_columns_are_not_read(spark):
    odd = spark.createDataFrame(rows(), SCHEMA).withColumns({n: F.lit(1) for n in ("h1", "n", "class_id")})
    assert near_embeddings(odd).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_empty_table(spark):
    assert near_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nothing_usable(spark):
    frame = spark.createDataFrame([(1, None, 1), (2, [1.0], None)], SCHEMA)
    assert sorted(map(tuple, near_embeddings(frame).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_extreme_cluster_keeps_every_link_and_few_edges(spark):
    near = vectors(4, 700, 1, 0.02)
    far = vectors(5, 100, 100, 0.02)
    data = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([near, far]))]
    frame = spark.createDataFrame(data, SCHEMA)
    got = [tuple(r) for r in near_embeddings(frame, shard=128, goal=1.0).collect()]
    assert sorted(got) == sorted(brute.embeddings(data))
    classes = frame.select("label", F.col("vec_id").alias("class_id"), F.lit(1).cast("long").alias("rows"), "embedding")
    found = embedding_dedup.links(classes, shard=128).collect()
    edges = [r for r in found if r.b is not None]
    shards = -(-len(data) // 128)
    # Fewer than the vectors of a cell, over all cells; the cluster alone has 244,650 pairs.
    assert len(edges) < shards * (shards + 1) // 2 * 2 * 150
    assert sum(r.around for r in found if r.b is None) == sum(n for _, n, _, _ in got)


def test_classes_weigh_what_they_stand_for(spark):
    points = vectors(6, 60, 4, 0.1)
    data = [(i, v.tolist(), 1) for i, v in enumerate(points)] + [(100 + i, points[0].tolist(), 1) for i in range(9)]
    frame = spark.createDataFrame(data, SCHEMA)
    got = [tuple(r) for r in near_embeddings(frame, shard=16, goal=1.0).collect()]
    assert sorted(got) == sorted(brute.embeddings(data))


def answers(graph, queries, least, beam):
    return np.concatenate([hit for _, hit in graph.within(queries, least, beam)])


def test_graph_recall_and_widening():
    points = embedding_dedup._unit(vectors(7, 3000, 150, 0.12, 32))
    graph = Graph(points)
    truth = points @ points.T >= 0.93
    ask = points.astype(np.float32)
    beam = audited(graph, ask, 0.93 - 1e-5, 0.99, own=True)
    found = answers(graph, ask, 0.93 - 1e-5, beam)
    assert (found & truth).sum() >= 0.98 * truth.sum()


def test_recall_over_several_shards():
    """Two shards with sparse links between them, each found by the other's graph."""
    one, other = np.random.default_rng(11).normal(size=(2, 4000, 32))
    twins = np.arange(0, 4000, 40)
    other[twins] = one[twins] + np.random.default_rng(13).normal(size=(100, 32)) * 0.1
    one, other = embedding_dedup._unit(one), embedding_dedup._unit(other)
    truth = other @ one.T >= 0.93
    assert 50 <= truth.sum() <= 200
    graph, ask = Graph(one), other.astype(np.float32)
    beam = audited(graph, ask, 0.93 - 1e-5, 0.999)
    assert (answers(graph, ask, 0.93 - 1e-5, beam) & truth).sum() >= 0.999 * truth.sum()


def test_audit_sees_sparse_links():
    """One link among 2,000 queries is enough to refuse a graph that does not reach it."""
    points = embedding_dedup._unit(np.random.default_rng(14).normal(size=(2000, 16)))
    graph = Graph(points)
    lost = 1234
    for links in graph.links:
        links[np.isin(links, np.flatnonzero(graph.order == lost))] = -1
    ask = embedding_dedup._unit(np.random.default_rng(15).normal(size=(2000, 16))).astype(np.float32)
    ask[777] = points[lost]
    assert audited(graph, ask, 0.9999, 0.999) is None
    assert answers(graph, ask, 0.9999, None)[777, lost]


def test_audit_falls_back_to_all_vectors():
    points = embedding_dedup._unit(vectors(8, 300, 3, 0.05))
    graph, ask = Graph(points, beam=1), points.astype(np.float32)
    beam = audited(graph, ask, 0.93, 2.0)
    assert beam is None
    assert (answers(graph, ask, 0.93, beam) == (ask @ ask.T >= 0.93)).all()


def test_packed_shard_answers_alike():
    points = embedding_dedup._unit(vectors(9, 500, 20))
    shard = embedding_dedup.Shard(Graph(points), np.arange(500), np.ones(500, np.int64), points)
    other = embedding_dedup.Shard.unpack(shard.pack())
    ask = points.astype(np.float32)
    assert (answers(shard.graph, ask, 0.9, 32) == answers(other.graph, ask, 0.9, 32)).all()
    assert (other.vectors == points).all() and (other.ids == np.arange(500)).all() and (other.rows == 1).all()
