"""The shape of the plans: no shuffle, one decode, only the needed columns."""

import re

import pytest
from envelopes import packed
from pyspark.sql import functions as F

import breachline as bl
from breachline.functions import codecs

RULES = [("acme", 1), ("corp", 2), ("test", 3)]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "envelopes")
    value = F.lit(bytearray(packed('[{"requesturl":"acme"},{},7]')))
    rows = spark.range(0, 100, 1, 4).select(
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows.write.parquet(path)
    return path


def jobs(spark, path):
    frame = bl.read_envelopes(spark, path=path)
    rules = [bl.rule_contains("requesturl", token, policy) for token, policy in RULES]
    detected = bl.detect(frame, rules)
    return {
        "detect": detected,
        "promote": bl.promote(frame),
        "encode": bl.encode_events(detected, "gzip"),
        "route_detect": bl.route_detect(frame, rules),
        "route_promote": bl.route_promote(frame),
        "quarantine": bl.quarantine(bl.decompress_envelopes(frame)),
        "two steps": bl.only_violations(
            bl.apply_rules(bl.decode_events(bl.decompress_envelopes(frame)), rules)
        ),
    }


JOBS = ["detect", "promote", "encode", "route_detect", "route_promote", "quarantine", "two steps"]


@pytest.mark.parametrize("name", JOBS)
def test_plan(spark, stored, name):
    plan = plan_of(jobs(spark, stored)[name])
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython [inflate") == 1
    # One reader of lists; that for single values only tells why a bad text is bad.
    assert plan.count("from_json(ArrayType") == 1 and plan.count("from_json(VariantType") <= 1
    assert "BatchEvalPython" not in plan
    (columns,) = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert columns == "value:binary,topic:string,partition:int,offset:bigint"


@pytest.mark.parametrize("name", ["detect", "route_detect", "two steps"])
def test_fields_are_read_once_however_many_rules(spark, stored, name):
    plan = plan_of(jobs(spark, stored)[name])
    assert plan.count("try_cast(") - plan.count("as map<string,variant>") == 1


@pytest.mark.parametrize("name", JOBS)
def test_each_envelope_is_inflated_once(spark, stored, name, monkeypatch):
    calls = spark.sparkContext.accumulator(0)
    real = codecs._gunzip

    def counted(block):
        calls.add(1)
        return real(block)

    monkeypatch.setattr(codecs, "_gunzip", counted)
    jobs(spark, stored)[name].write.format("noop").mode("overwrite").save()
    assert calls.value == 100


def test_no_codec_needs_no_python(spark, stored):
    frame = bl.read_envelopes(spark, path=stored)
    plan = plan_of(bl.route_detect(frame, [bl.rule_contains("requesturl", "a", 1)], "none"))
    assert "Python" not in plan


def test_filter_on_coordinates_reaches_the_scan(spark, stored):
    frame = bl.read_envelopes(spark, path=stored).where("offset >= 90")
    plan = plan_of(bl.route_detect(frame, [bl.rule_contains("requesturl", "a", 1)]))
    assert "GreaterThanOrEqual(offset,90)" in plan


def test_rebalance_shuffles_output_rows_only(spark, stored, tmp_path):
    frame = bl.read_envelopes(spark, path=stored)
    rules = [bl.rule_contains("requesturl", "acme", 1)]
    for rebalance in (False, True):
        target = str(tmp_path / str(rebalance))
        routed = bl.route_detect(frame, rules)
        bl.write_violations(routed, bl.FileSink(target), rebalance=rebalance)
        back = spark.read.parquet(target)
        assert {r.output: r["count"] for r in back.groupBy("output").count().collect()} == {
            "violations": 100,
            "quarantine": 100,
        }
        files = len(back.inputFiles())
        assert files == 2 if rebalance else files == 8
