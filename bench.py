"""Time the jobs over envelopes made from the tables; prints one JSON line.

BENCH_SF_DIR is the folder of tables and BENCH_CPUS the number of local cores. Packing the envelopes
is not timed. `floor_detect` is the same detection on the plain table: what is left when there is
nothing to decompress, parse or explode.
"""

from __future__ import annotations

import gzip
import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import breachline as bl
from breachline.plans.replay import pack_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3

EVENT = "event_id bigint, event_type string"


def stage(spark, name, rows, codec, events_per_message):
    path = os.path.join(STAGE, f"{name}_{codec}")
    packed = pack_table(rows.repartition(int(CPUS)), codec, events_per_message)
    packed.write.parquet(path)
    return bl.read_envelopes(spark, path=path)


def gzip_text(text):
    return F.lit(bytearray(gzip.compress(text.encode(), mtime=0)))


def run(frame):
    frame.write.format("noop").mode("overwrite").save()


def stream(spark, routed):
    folder = tempfile.mkdtemp(prefix="stream-", dir=STAGE)
    bl.run_detection(
        routed, bl.FileSink(f"{folder}/out"), f"{folder}/progress", available_now=True
    ).awaitTermination()


def write(routed):
    folder = tempfile.mkdtemp(prefix="out-", dir=STAGE)
    bl.write_violations(routed, bl.FileSink(folder), "overwrite")


def jobs(spark):
    policy = F.get_json_object("props", "$.k").cast("bigint").alias("policyId")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    carried = events.withColumn("customViolations", F.array(F.struct(policy)))
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tenfold = carried.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10))))
    ten = stage(spark, "tenfold", tenfold, "gzip", 100)
    by_codec = {c: stage(spark, "events", carried, c, 100) for c in ("none", "gzip", "snappy")}
    texts = stage(spark, "documents", documents, "gzip", 16)
    packed = by_codec["gzip"]
    # One envelope in ten is damaged: cut short, no gzip, or no list.
    damage = F.col("offset") % 30
    value = F.when(damage == 0, F.substring("value", 1, 99)).when(
        damage == 1, F.lit(bytearray(b"no gzip"))
    )
    bad = packed.withColumn("value", value.when(damage == 2, gzip_text("{}")).otherwise(F.col("value")))
    rules = [bl.rule_contains("event_type", "err", 9999)]
    many = [bl.rule_contains("event_type", f"absent{i}", i) for i in range(50)] + rules
    tokens = [bl.TokenRules("event_type", [(f"absent{i}", i) for i in range(1999)] + [("err", 9999)])]
    text_rules = [bl.rule_contains("text", "License", 1)]

    def decode(codec):
        return bl.decode_events(bl.decompress_envelopes(by_codec[codec], codec), EVENT)

    def incoming():
        path = os.path.join(STAGE, "events_gzip")
        return bl.read_envelopes(spark, path=path, streaming=True)

    return {
        "floor_detect": lambda: run(events.where(F.contains("event_type", F.lit("err")))),
        "decode_none": lambda: run(decode("none")),
        "decode_gzip": lambda: run(decode("gzip")),
        "decode_snappy": lambda: run(decode("snappy")),
        "detect": lambda: run(bl.detect(packed, rules, fields=EVENT)),
        "detect_51_rules": lambda: run(bl.detect(packed, many, fields=EVENT)),
        "detect_2000_tokens": lambda: run(bl.detect(packed, tokens, fields=EVENT)),
        "detect_2000_tokens_tenfold": lambda: run(bl.detect(ten, tokens, fields=EVENT)),
        "detect_guarded": lambda: run(
            bl.route_detect(packed, rules, fields=EVENT, on_rule_error="quarantine")
        ),
        "detect_partitions": lambda: run(bl.route_detect(packed, rules, fields=EVENT, form="partitions")),
        "detect_text": lambda: run(bl.detect(texts, text_rules, fields="text string")),
        "detect_publish": lambda: write(bl.route_detect(packed, rules, fields=EVENT, out_codec="none")),
        "promote": lambda: run(bl.promote(packed)),
        "promote_publish": lambda: write(bl.route_promote(packed, out_codec="none")),
        "republish": lambda: run(bl.encode_events(bl.detect(packed, rules, fields=EVENT), "gzip")),
        "pack": lambda: run(bl.pack_events(bl.promote(packed), codec="gzip")),
        "quarantine": lambda: run(bl.quarantine(bl.decompress_envelopes(packed))),
        "quarantine_bad_tenth": lambda: run(bl.quarantine(bl.decompress_envelopes(bad))),
        "detect_lists": lambda: run(bl.route_detect(packed, rules, fields=EVENT, form="lists")),
        "decode_gzip_tenfold": lambda: run(bl.decode_events(bl.decompress_envelopes(ten), EVENT)),
        "detect_tenfold": lambda: run(bl.detect(ten, rules, fields=EVENT)),
        "promote_publish_tenfold": lambda: write(bl.route_promote(ten, out_codec="none")),
        "stream_detect": lambda: stream(
            spark, bl.route_detect(incoming(), rules, fields=EVENT, out_codec="none")
        ),
        "stream_promote": lambda: stream(
            spark, bl.route_promote(incoming(), out_codec="none")
        ),
    }, events.count()


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("breachline-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # Local files are small; split them so that every core has work.
        .config("spark.sql.files.maxPartitionBytes", "8m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo, n_events = jobs(spark)
    seconds = {}
    for name, job in todo.items():
        times = []
        for _ in range(REPEATS + 1):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 4)
    per_second = {
        name: round(n_events * (10 if name.endswith("tenfold") else 1) / s)
        for name, s in seconds.items()
        if name != "detect_text"
    }
    print(
        json.dumps(
            {
                "metric": "total time of all jobs, best of three",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "events_per_sec": per_second,
                "events": n_events,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    STAGE = tempfile.mkdtemp(prefix="bench-")
    main()
