"""Positions, rates per partition, stops between batches, repeats."""

import json
import time

import pytest
from envelopes import envelopes, packed
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import breachline as bl
from breachline.plans import table_queries
from breachline.sources.positions import _MOST_RANGES, _ranges, capped_end, positions_json

TEXT = '[{"requesturl":"u"}]'


def test_positions_as_a_start():
    options = bl.kafka_source_options("b:1", "t,u", start={"u": {0: 5}, "t": {1: 7, 0: -2}})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": -2, "1": 7}, "u": {"0": 5}}
    assert bl.positions_of(options["startingOffsets"]) == {"t": {0: -2, 1: 7}, "u": {0: 5}}
    assert bl.positions_of(None) == {}


def test_a_batch_between_positions():
    options = bl.kafka_source_options("b:1", "t", start={"t": {0: 1}}, end={"t": {0: 4}}, streaming=False)
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 4}}


@pytest.mark.parametrize(
    "more",
    [
        {"start": {"t": {0: 1}, "v": {0: 1}}},
        {"start": {}},
        {"start": {"t": {0: -3}}},
        {"start": {"t": {-1: 3}}},
        {"end": {"t": {0: 1}}},
        {"end": {"v": {0: 1}}, "streaming": False},
    ],
)
def test_positions_that_do_not_fit_are_refused(more):
    with pytest.raises(ValueError):
        bl.kafka_source_options("b:1", "t", **more)


offsets = st.dictionaries(
    st.sampled_from("tuv"), st.dictionaries(st.integers(0, 3), st.integers(0, 60), min_size=1), max_size=3
)


@settings(max_examples=200, deadline=None)
@given(offsets, offsets, st.integers(1, 9))
def test_no_cap_is_passed_and_no_partition_starves(start, more, most):
    latest = {
        t: {p: start.get(t, {}).get(p, 0) + more.get(t, {}).get(p, 0) for p in {**start.get(t, {}), **more.get(t, {})}}
        for t in {**start, **more}
    }
    now = {t: {p: start.get(t, {}).get(p, 0) for p in ps} for t, ps in latest.items()}
    for begin, end in bl.capped_batches(start, latest, most, 1):
        assert begin == now
        for t, ps in latest.items():
            for p, last in ps.items():
                took = end[t][p] - begin[t][p]
                assert took == min(most, last - begin[t][p])
        now = end
    assert now == latest


def test_a_start_beyond_the_end_is_refused():
    with pytest.raises(ValueError):
        capped_end({"t": {0: 5}}, {"t": {0: 4}}, 1)
    with pytest.raises(ValueError):
        list(bl.capped_batches({}, {"t": {0: 4}}, 0.1, 1))


def rows(spark, *places):
    frame = spark.createDataFrame([(t, p, o) for t, p, o in places], "topic string, partition int, offset bigint")
    base = envelopes(spark, [packed(TEXT)]).drop("topic", "partition", "offset")
    return frame.withColumns({c: F.lit(None).cast(base.schema[c].dataType) for c in base.columns}).withColumn(
        "value", F.lit(bytearray(packed(TEXT)))
    ).select(*bl.ENVELOPE.names)


def places(frame):
    return sorted((r.topic, r.partition, r.offset) for r in frame.collect())


def test_between(spark):
    every = [("t", 0, 0), ("t", 0, 1), ("t", 0, 2), ("t", 1, 1), ("u", 0, 9), ("v", 0, 3)]
    frame = rows(spark, *every)
    start = {"t": {0: 1}, "u": {0: 10}}
    assert places(bl.between(frame, {})) == every
    assert places(bl.between(frame, start)) == [("t", 0, 1), ("t", 0, 2), ("t", 1, 1), ("v", 0, 3)]
    assert places(bl.between(frame, start, {"t": {0: 2, 1: 2}})) == [("t", 0, 1), ("t", 1, 1)]
    assert places(bl.between(frame, start, {"t": {0: 2}})) == [("t", 0, 1)]
    assert places(bl.between(frame, start, {})) == []


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "in")
    rows(spark, ("t", 0, 0), ("t", 0, 5)).write.parquet(path)
    cut = bl.between(bl.read_envelopes(spark, path=path), {"t": {0: 2}}, {"t": {0: 9}})
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(offset,9)" in plan and "GreaterThanOrEqual(offset,2)" in plan


def test_positions_kept_never_go_back(spark, tmp_path):
    store = bl.PositionStore(spark, str(tmp_path / "positions"))
    assert store.load() == {}
    store.save({"t": {0: 5, 1: 0}})
    store.save(bl.next_positions(rows(spark, ("t", 0, 2), ("u", 3, 6))))
    assert store.load() == {"t": {0: 5, 1: 0}, "u": {3: 7}}
    for n in (6, 7, 8):
        store.save({"t": {0: n}})
    assert store.load()["t"][0] == 8
    # A step that was not finished does not count, and old ones go.
    kept = sorted(p.name for p in (tmp_path / "positions").iterdir())
    assert len(kept) == 2
    (tmp_path / "positions" / kept[-1] / "_SUCCESS").unlink()
    assert store.load()["t"][0] == 7


def job(spark, tmp_path, name, **options):
    return bl.run_detection(
        bl.read_envelopes(spark, path=str(tmp_path / "in"), streaming=True, max_files_per_trigger=1),
        bl.FileSink(str(tmp_path / "out")),
        str(tmp_path / "progress"),
        route=lambda b: bl.route_detect(b, [bl.rule_contains("requesturl", "u", 1)], out_codec="none"),
        stop_marker=str(tmp_path / "stop"),
        name=name,
        **options,
    )


def arrive(spark, tmp_path, first, n):
    for i in range(first, first + n):
        rows(spark, ("t", 0, i)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def published(spark, tmp_path):
    return sorted(r.offset for r in spark.read.parquet(str(tmp_path / "out")).collect())


def test_a_stop_lets_the_batch_in_progress_finish_and_nothing_repeats(spark, tmp_path):
    arrive(spark, tmp_path, 0, 4)
    marker, begun = str(tmp_path / "stop"), []

    def hook(batch, n):
        begun.append(n)
        if n == 1:
            bl.ask_to_stop(spark, marker)
            time.sleep(1)

    query = job(spark, tmp_path, "stopped", on_batch=hook, available_now=True)
    assert bl.await_stop(query, marker)
    assert begun == [0, 1] and published(spark, tmp_path) == [0, 1]
    assert sorted(p.name for p in (tmp_path / "progress" / "commits").glob("[0-9]")) == ["0", "1"]
    (tmp_path / "stop").unlink()
    again = job(spark, tmp_path, "again", on_batch=lambda b, n: begun.append(n), available_now=True)
    assert not bl.await_stop(again, marker)
    assert begun == [0, 1, 2, 3] and published(spark, tmp_path) == [0, 1, 2, 3]


def test_a_query_that_waits_is_stopped(spark, tmp_path):
    arrive(spark, tmp_path, 0, 1)
    query = job(spark, tmp_path, "waiting")
    query.processAllAvailable()
    bl.ask_to_stop(spark, str(tmp_path / "stop"))
    assert bl.await_stop(query, str(tmp_path / "stop"))
    assert published(spark, tmp_path) == [0]


def test_other_failures_are_raised(spark, tmp_path):
    arrive(spark, tmp_path, 0, 1)

    def fail(batch, n):
        raise RuntimeError("broken")

    query = job(spark, tmp_path, "broken", on_batch=fail, available_now=True)
    with pytest.raises(Exception, match="broken"):
        bl.await_stop(query, str(tmp_path / "stop"))


def test_positions_need_envelopes(spark, tmp_path):
    arrive(spark, tmp_path, 0, 1)
    stream = bl.read_envelopes(spark, path=str(tmp_path / "in"), streaming=True)
    with pytest.raises(ValueError):
        bl.run_detection(stream, bl.FileSink("x"), "y", positions="z")


def messages(spark, *keys):
    keyed = [(None if k is None else bytearray(k.encode()), bytearray(b"v")) for k in keys]
    return spark.createDataFrame(keyed, "key binary, value binary").withColumn(
        "timestamp", F.lit("2026-01-01").cast("timestamp")
    )


def keys(frame):
    return sorted((bytes(r.key).decode() if r.key else "-") for r in frame.collect())


def test_repeats_of_a_table(spark):
    got = bl.drop_repeats(messages(spark, "a", "b", "a", None, None, "a"))
    assert keys(got) == ["-", "-", "a", "b"]
    assert got.columns == ["key", "value", "timestamp"]


def test_a_replayed_batch_gives_the_same_rows(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def read():
        stream = spark.readStream.schema("key binary, value binary, timestamp timestamp").parquet(source)
        writer = bl.drop_repeats(stream).writeStream.trigger(availableNow=True)
        writer.option("checkpointLocation", progress).start(out).awaitTermination()
        return keys(spark.read.parquet(out))

    messages(spark, "a", "b", None).write.mode("append").parquet(source)
    assert read() == ["-", "a", "b"]
    messages(spark, "b", "a", "c").write.mode("append").parquet(source)
    assert read() == ["-", "a", "b", "c"]


def test_positions_text_is_sorted():
    assert positions_json({"b": {2: 1, 1: 2}, "a": {}}) == '{"a": {}, "b": {"1": 2, "2": 1}}'


def test_scan_skips_what_lies_between_partitions(spark, tmp_path):
    """Offsets of partitions lie far apart, and one between them has nothing left to read."""
    for p in range(3):
        part = envelopes(spark, [packed(TEXT)] * 20).coalesce(1)
        at = (F.lit(p << 33) + F.col("offset")).alias("offset")
        part.select("key", "value", "topic", F.lit(p).alias("partition"), at, "timestamp", "timestampType").write.mode(
            "append"
        ).parquet(str(tmp_path / "stored"))
    stored = bl.read_envelopes(spark, path=str(tmp_path / "stored"))
    topic = stored.first().topic
    start = {topic: {p: (p << 33) + (20 if p == 1 else 5) for p in range(3)}}
    end = {topic: {p: (p << 33) + (20 if p == 1 else 9) for p in range(3)}}
    some = bl.between(stored, start, end)
    got = sorted((r.partition, r.offset) for r in some.collect())
    assert got == [(p, (p << 33) + i) for p in (0, 2) for i in range(5, 9)]
    scan = some._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() <= 40  # of 60


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 3)), max_size=600))
def test_ranges_hold_every_partition(spans):
    start = {"t": {p: a for p, (a, _) in enumerate(spans)}}
    end = {"t": {p: a + n for p, (a, n) in enumerate(spans)}}
    found = _ranges(start, end)
    assert len(found) <= _MOST_RANGES
    assert all(a < b for a, b in found) and all(x[1] < y[0] for x, y in zip(found, found[1:]))
    assert all(any(a <= s and s + n <= b for a, b in found) for s, n in spans if n)


def test_batches_do_not_grow_in_number_with_the_table(spark, tmp_path, monkeypatch):
    pages = spark.range(400).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://example.com/"), "id").alias("url"), F.lit("x").alias("html")
    )
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(table_queries, "_BLOCK", 50, raising=False)
    write, batches = table_queries.write_violations, []

    def written(routed, sink):
        batches.append(routed)
        write(routed, sink)

    monkeypatch.setattr(table_queries, "write_violations", written)
    rows = table_queries.QUERIES["detect_capped"](spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in rows) == list(range(400))
    assert len(batches) == 2  # 100 envelopes, 50 to a partition, 25 of each in a batch
