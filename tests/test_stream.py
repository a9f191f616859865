import json

import pytest
from envelopes import envelopes, packed
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

import breachline as bl


def rules():
    return [bl.rule_contains("requesturl", "acme", 9999)]


def listed(start, stop):
    urls = [(i, "acme" if i % 2 else "x") for i in range(start, stop)]
    return ['[{"n":%d,"requesturl":"%s"},7]' % pair for pair in urls] + ["bad"]


class Feed:
    """A folder of envelopes that grows by one file per call."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.at = spark, str(folder / "in"), 0

    def add(self, texts):
        rows = envelopes(self.spark, [packed(t) for t in texts])
        rows = rows.withColumn("offset", (F.col("offset") + self.at).cast("long"))
        rows.coalesce(1).write.mode("append").parquet(self.path)
        self.at += len(texts)

    def stream(self, **options):
        return bl.read_envelopes(self.spark, path=self.path, streaming=True, **options)

    def table(self):
        return bl.read_envelopes(self.spark, path=self.path)


@pytest.fixture
def feed(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(listed(0, 10))
    feed.add(listed(10, 20))
    return feed


def content(frame):
    columns = ["output", "topic", "partition", "offset", "pos", "value", "reason"]
    rows = frame.select(*columns).withColumn("value", F.hex("value")).collect()
    return sorted(map(tuple, rows), key=repr)


def run(routed, sink, tmp_path, **options):
    checkpoint = str(tmp_path / "progress")
    query = bl.run_detection(routed, sink, checkpoint, available_now=True, **options)
    query.awaitTermination()
    return query


def test_stream_equals_batch(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    routed = bl.route_detect(feed.stream(max_files_per_trigger=1), rules())
    query = run(routed, bl.FileSink(target), tmp_path)
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 2
    assert content(spark.read.parquet(target)) == content(bl.route_detect(feed.table(), rules()))


def test_promotion_stream_equals_batch(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    run(bl.route_promote(feed.stream()), bl.FileSink(target), tmp_path)
    assert content(spark.read.parquet(target)) == content(bl.route_promote(feed.table()))


def test_empty_rules_give_quarantine_only(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    run(bl.route_detect(feed.stream(), []), bl.FileSink(target), tmp_path)
    assert {r.output for r in spark.read.parquet(target).collect()} == {"quarantine"}


def test_restart_goes_on_where_it_stopped(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    for _ in range(2):
        run(bl.route_detect(feed.stream(), rules()), bl.FileSink(target), tmp_path)
        feed.add(listed(20, 25))
        run(bl.route_detect(feed.stream(), rules()), bl.FileSink(target), tmp_path)
    assert content(spark.read.parquet(target)) == content(bl.route_detect(feed.table(), rules()))


def test_two_sinks_and_hook(spark, feed, tmp_path):
    good, bad, seen = str(tmp_path / "good"), str(tmp_path / "bad"), []
    run(
        bl.route_detect(feed.stream(max_files_per_trigger=1), rules()),
        bl.FileSink(good),
        tmp_path,
        quarantine_sink=bl.FileSink(bad),
        on_batch=lambda rows, batch_id: seen.append((batch_id, rows.count())),
    )
    expected = bl.route_detect(feed.table(), rules())
    assert content(spark.read.parquet(good)) == content(expected.where("output = 'violations'"))
    assert content(spark.read.parquet(bad)) == content(expected.where("output = 'quarantine'"))
    assert [batch_id for batch_id, _ in seen] == [0, 1]
    assert sum(n for _, n in seen) == expected.count()


def test_failed_batch_is_done_again_without_repeats(spark, feed, tmp_path):
    good, bad, failures = str(tmp_path / "good"), str(tmp_path / "bad"), ["once"]

    def hook(rows, batch_id):
        if batch_id == 1 and failures:
            raise RuntimeError(failures.pop())

    def attempt():
        run(
            bl.route_detect(feed.stream(max_files_per_trigger=1), rules()),
            bl.FileSink(good),
            tmp_path,
            quarantine_sink=bl.FileSink(bad),
            on_batch=hook,
        )

    with pytest.raises(PySparkException, match="once"):
        attempt()
    attempt()
    expected = bl.route_detect(feed.table(), rules())
    assert content(spark.read.parquet(good)) == content(expected.where("output = 'violations'"))
    assert content(spark.read.parquet(bad)) == content(expected.where("output = 'quarantine'"))


def test_interval_trigger(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    routed = bl.route_detect(feed.stream(), rules())
    checkpoint = str(tmp_path / "progress")
    query = bl.run_detection(
        routed, bl.FileSink(target), checkpoint, interval="1 second", name="detection"
    )
    query.processAllAvailable()
    assert query.name == "detection" and query.isActive
    query.stop()
    assert content(spark.read.parquet(target)) == content(bl.route_detect(feed.table(), rules()))
    with pytest.raises(ValueError):
        bl.run_detection(routed, bl.FileSink(target), "c", interval="1 second", available_now=True)


def test_published_payloads(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    routed = bl.route_detect(feed.stream(), rules(), out_codec="none")
    run(routed, bl.FileSink(target), tmp_path)
    rows = spark.read.parquet(target).where("output = 'violations'").collect()
    events = [event for r in rows for event in json.loads(bytes(r.value))]
    assert sorted(e["n"] for e in events) == list(range(1, 20, 2))
    assert all(e["violations"] == [{"policyId": 9999}] for e in events)


def test_sinks_may_share_a_path(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    routed = bl.route_detect(feed.stream(max_files_per_trigger=1), rules())
    run(routed, bl.FileSink(target), tmp_path, quarantine_sink=bl.FileSink(target))
    assert content(spark.read.parquet(target)) == content(bl.route_detect(feed.table(), rules()))


def test_new_checkpoint_on_an_old_target_erases_nothing(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    for n in range(2):
        routed = bl.route_detect(feed.stream(), rules())
        query = bl.run_detection(
            routed, bl.FileSink(target), str(tmp_path / f"progress{n}"), available_now=True
        )
        query.awaitTermination()
    once = content(bl.route_detect(feed.table(), rules()))
    assert content(spark.read.parquet(target)) == sorted(once * 2, key=repr)


def test_hook_added_on_restart_hides_nothing(spark, feed, tmp_path):
    target, seen = str(tmp_path / "out"), []
    run(bl.route_detect(feed.stream(), rules()), bl.FileSink(target), tmp_path)
    feed.add(listed(20, 30))
    run(
        bl.route_detect(feed.stream(), rules()),
        bl.FileSink(target),
        tmp_path,
        on_batch=lambda rows, n: seen.append(rows.count()),
    )
    assert seen == [5 + 10 + 1]
    assert content(spark.read.parquet(target)) == content(bl.route_detect(feed.table(), rules()))


def test_crash_between_two_writes_repeats_nothing(spark, feed, tmp_path):
    target, fail = str(tmp_path / "out"), [True]

    def hook(rows, batch_id):
        if fail.pop() if fail else False:
            raise RuntimeError("crash after both writes")

    options = {"quarantine_sink": bl.FileSink(target), "on_batch": hook}
    with pytest.raises(PySparkException):
        run(bl.route_detect(feed.stream(), rules()), bl.FileSink(target), tmp_path, **options)
    run(bl.route_detect(feed.stream(), rules()), bl.FileSink(target), tmp_path, **options)
    assert content(spark.read.parquet(target)) == content(bl.route_detect(feed.table(), rules()))


def test_folder_with_another_log_is_refused(spark, feed, tmp_path):
    target = tmp_path / "out"
    (target / "_spark_metadata").mkdir(parents=True)
    for more in ({}, {"quarantine_sink": bl.FileSink(str(tmp_path / "bad"))}):
        with pytest.raises(ValueError, match="another kind of stream"):
            run(bl.route_detect(feed.stream(), rules()), bl.FileSink(str(target)), tmp_path, **more)


def test_stream_files_are_evened_out(spark, feed, tmp_path):
    many = bl.route_detect(feed.stream(), rules())
    run(many.repartition(6), bl.FileSink(str(tmp_path / "a")), tmp_path / "1")
    run(many.repartition(6), bl.FileSink(str(tmp_path / "b")), tmp_path / "2", rebalance=True)
    files = [len(spark.read.parquet(str(tmp_path / n)).inputFiles()) for n in "ab"]
    assert files[1] <= 2 < files[0]


@pytest.mark.parametrize("promote", [False, True])
def test_counts_are_reported(spark, feed, tmp_path, promote):
    def routed(table, counts):
        if promote:
            return bl.route_promote(table, counts=counts)
        return bl.route_detect(table, rules(), counts=counts)

    query = run(routed(feed.stream(), "counts"), bl.FileSink(str(tmp_path / "out")), tmp_path)
    seen = query.lastProgress.observedMetrics["counts"].asDict()
    watch = Observation()
    routed(feed.table(), watch).write.format("noop").mode("overwrite").save()
    assert watch.get == seen
    assert (seen["events"], seen["not_object"], seen["decompress"]) == (20, 20, 0)
    assert seen["parse"] + seen["not_array"] == 2
    assert promote or seen["violating"] == 10


def test_stream_of_lists(spark, feed, tmp_path):
    target = str(tmp_path / "out")
    run(bl.route_detect(feed.stream(), rules(), form="lists"), bl.FileSink(target), tmp_path)
    batch = bl.route_detect(feed.table(), rules(), form="lists")
    assert content(spark.read.parquet(target)) == content(batch)


def test_settings_that_mean_nothing_are_refused(spark, feed):
    routed = bl.route_detect(feed.table(), rules())
    for more in ({"mode": "overwrite"}, {"rebalance": True}):
        with pytest.raises(ValueError):
            bl.write_violations(routed, bl.KafkaSink("b", "v"), **more)
    with pytest.raises(ValueError):
        bl.write_violations(bl.route_detect(feed.stream(), []), bl.FileSink("x"), mode="overwrite")
