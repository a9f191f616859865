"""The operators run over whole tables, each with SQL that gives the same rows.

Every query packs a table into compressed envelopes and takes it through the pipeline. The SQL reads
the plain table and never sees an envelope, so agreement shows that the round trip loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codecs import compress
from ..operators.decode import (
    decode_events,
    decode_outcomes,
    decompress_envelopes,
    events_of,
    quarantine_of,
)
from ..operators.encode import encode_events, pack_events
from ..operators.rules import (
    Rule,
    TokenRules,
    apply_rules,
    only_violations,
    python_rule,
    read_rules,
    rule_contains,
)
from ..operators.repeats import drop_repeats
from ..sinks.violations import FileSink, write_violations
from ..sources.envelopes import read_envelopes
from ..sources.positions import (
    PositionStore,
    between,
    capped_batches,
    collect_positions,
    first_positions,
    next_positions,
)
from ..streaming.job import run_detection
from .jobs import detect, promote, route_detect, route_promote
from .replay import as_envelopes, event_json, pack_table, scratch

Query = Callable[[SparkSession, str], DataFrame]

POLICY = 9999
PAGE = "page_id bigint, requesturl string"
PAGE_RULES = [("example.com", 101), ("utm_source", 102), ("/en/", 103)]
EVENT = "event_id bigint, event_type string"
CARRIED = EVENT + ", user_id bigint, value double"
PUBLISHED = CARRIED + ", ts timestamp_ntz, props string, violations array<struct<policyId:bigint>>"
CUSTOM = ", customViolations array<struct<policyId:bigint>>"
WHOLE = ("event_id", "event_type", "user_id", "value", "props")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").withColumn("requesturl", F.col("url"))


def _events_with_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = F.get_json_object("props", "$.k").cast("bigint").alias("policyId")
    return _table(spark, sf_dir, "events").withColumn("customViolations", F.array(F.struct(policy)))


def _events_with_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.array(F.struct(F.lit(1).alias("policyId"), F.lit("old").alias("note")))
    return _table(spark, sf_dir, "events").withColumn("violations", old)


def _flat(flagged: DataFrame, *columns: str) -> DataFrame:
    return flagged.select(*columns, F.inline("violations")).withColumnRenamed(
        "policyId", "policy_id"
    )


def _seconds() -> Column:
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")


def _custom() -> Column:
    return F.coalesce(F.col("customViolations")[0]["policyId"], F.lit(-1)).alias("custom_id")


def _reread(messages: DataFrame, fields: str, codec: str) -> DataFrame:
    """Published messages decoded again, as a downstream reader would."""
    at = as_envelopes(messages, offset=F.monotonically_increasing_id())
    return decode_events(decompress_envelopes(at, codec), fields)


def _decode(codec: str) -> Query:
    def query(spark, sf_dir):
        envelopes = pack_table(_table(spark, sf_dir, "pages"), codec)
        fields = "page_id bigint, url string, html string"
        decoded = decode_events(decompress_envelopes(envelopes, codec), fields)
        return decoded.select("page_id", "url", F.md5("html").alias("html_md5"))

    return query


def _detect_url(spark, sf_dir):
    envelopes = pack_table(_pages(spark, sf_dir), "gzip")
    rules = [rule_contains("requesturl", "example.com", POLICY)]
    return _flat(detect(envelopes, rules, fields=PAGE), "page_id", "requesturl")


def _detect_multi_rule(spark, sf_dir):
    envelopes = pack_table(_pages(spark, sf_dir), "snappy")
    rules = [rule_contains("requesturl", token, policy) for token, policy in PAGE_RULES]
    flagged = detect(envelopes, rules, "snappy", PAGE)
    return flagged.select(
        "page_id", "requesturl", F.posexplode("violations").alias("nth", "violation")
    ).select("page_id", "requesturl", "nth", F.col("violation.policyId").alias("policy_id"))


def _detect_event_type(spark, sf_dir):
    envelopes = pack_table(_table(spark, sf_dir, "events"), "gzip", events_per_message=100)
    rules = [rule_contains("event_type", "err", POLICY)]
    return _flat(detect(envelopes, rules, fields=EVENT), "event_id", "event_type")


def _detect_sparse_field(spark, sf_dir):
    kind = F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("event_type"))
    rows = _table(spark, sf_dir, "events").withColumn("event_type", kind)
    rules = [rule_contains("event_type", "err", POLICY)]
    events = decode_events(decompress_envelopes(pack_table(rows, "none"), "none"), EVENT)
    return _flat(only_violations(apply_rules(events, rules)), "event_id", "event_type")


def _detect_text(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents")
    rules = [rule_contains("text", "License", POLICY), rule_contains("text", "sch ", 17)]
    flagged = detect(pack_table(rows, "gzip"), rules, fields="doc_id bigint, text string")
    return _flat(flagged.withColumn("n", F.length("text")), "doc_id", "n")


def _detect_custom_logic(spark, sf_dir):
    rules = [
        Rule(7001, (F.col("event_type") == "purchase") & (F.col("value") > 150)),
        Rule(7002, F.try_variant_get("event", "$.user_id", "bigint") < 20),
    ]
    envelopes = pack_table(_table(spark, sf_dir, "events"), "gzip")
    fields = EVENT + ", value double"
    return _flat(detect(envelopes, rules, fields=fields), "event_id")


def _detect_udf_rule(spark, sf_dir):
    def longer(text: pa.Array) -> pa.Array:
        return pc.greater(pc.utf8_length(text), 50)

    is_long = F.arrow_udf(longer, "boolean").asNondeterministic()
    envelopes = pack_table(_pages(spark, sf_dir), "gzip")
    rules = [Rule(8001, is_long(F.col("requesturl")))]
    return _flat(detect(envelopes, rules, fields=PAGE), "page_id", "requesturl")


def _template_audit(spark, sf_dir):
    envelopes = pack_table(_table(spark, sf_dir, "events"), "gzip")
    flagged = apply_rules(decode_events(decompress_envelopes(envelopes), EVENT), rules=[])
    return flagged.agg(
        F.count("event_id").alias("decoded"),
        F.count_if(F.size("violations") > 0).alias("violating"),
    )


def _promote_custom(spark, sf_dir):
    promoted = promote(pack_table(_events_with_custom(spark, sf_dir), "gzip"))
    return promoted.select(
        F.try_variant_get("event", "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get("violations", "$[0].policyId", "bigint").alias("policy_id"),
    )


def _promote_missing(spark, sf_dir):
    rows = _events_with_custom(spark, sf_dir)
    rows = rows.withColumn(
        "customViolations", F.when(F.col("event_type") == "view", F.col("customViolations"))
    )
    published = encode_events(promote(pack_table(rows, "gzip")), codec="gzip")
    again = _reread(published, PUBLISHED + CUSTOM, "gzip")
    policy = F.coalesce(F.col("violations")[0]["policyId"], F.lit(-1)).alias("policy_id")
    return again.select(*WHOLE, _seconds(), _custom(), policy)


def _promote_republish(spark, sf_dir):
    rows = _events_with_custom(spark, sf_dir)
    routed = route_promote(pack_table(rows, "snappy", 100), "snappy", out_codec="gzip")
    published = routed.where(F.col("output") == "violations")
    return _flat(_reread(published, PUBLISHED + CUSTOM, "gzip"), *WHOLE, _seconds(), _custom())


def _republish_roundtrip(spark, sf_dir):
    envelopes = pack_table(_table(spark, sf_dir, "events"), "gzip")
    flagged = detect(envelopes, [rule_contains("event_type", "err", POLICY)], fields=EVENT)
    published = encode_events(flagged, codec="snappy")
    return _flat(_reread(published, PUBLISHED, "snappy"), *WHOLE, _seconds())


def _replace_violations(spark, sf_dir):
    envelopes = pack_table(_events_with_old(spark, sf_dir), "gzip")
    flagged = detect(envelopes, [rule_contains("event_type", "sign", POLICY)], fields=EVENT)
    again = _reread(encode_events(flagged), PUBLISHED, "none")
    return again.select(
        *WHOLE,
        _seconds(),
        F.size("violations").alias("n"),
        F.col("violations")[0]["policyId"].alias("policy_id"),
    )


def _pack_roundtrip(spark, sf_dir):
    envelopes = pack_table(_table(spark, sf_dir, "documents"), "gzip")
    flagged = detect(envelopes, [Rule(POLICY, F.col("n_chars") > 0)], fields="n_chars bigint")
    published = pack_events(flagged, events_per_message=50, codec="gzip")
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    again = _reread(published, fields, "gzip")
    return again.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


def _damaged_pages(spark, sf_dir):
    """One envelope per page; its id decides how it is damaged, if at all."""
    case = F.col("page_id") % 7
    event = event_json("page_id", F.col("url").alias("requesturl"), "html")
    text = (
        F.when(case == 2, F.concat(F.lit("["), event, F.lit(",{broken]")))
        .when(case == 3, event)
        .when(case == 4, F.concat(F.lit("["), event, F.lit(',7,"text"]')))
        .otherwise(F.concat(F.lit("["), event, F.lit("]")))
    )
    packed = _table(spark, sf_dir, "pages").select(
        "page_id", case.alias("case"), compress(text, "gzip").alias("packed")
    )
    cut = F.substr("packed", F.lit(1), F.length("packed") - 9)
    value = (
        F.when(F.col("case") == 0, F.lit("no gzip").cast("binary"))
        .when(F.col("case") == 1, cut)
        .otherwise(F.col("packed"))
    )
    return as_envelopes(packed.select("page_id", value.alias("value")), offset=F.col("page_id"))


def _quarantine_rows(spark, sf_dir):
    outcomes = decode_outcomes(decompress_envelopes(_damaged_pages(spark, sf_dir)), PAGE)
    return quarantine_of(outcomes).select(
        F.col("offset").alias("page_id"), F.coalesce("pos", F.lit(-1)).alias("pos"), "reason"
    )


def _quarantine_counts(spark, sf_dir):
    return _quarantine_rows(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"))


def _quarantine_survivors(spark, sf_dir):
    outcomes = decode_outcomes(decompress_envelopes(_damaged_pages(spark, sf_dir)), PAGE)
    return events_of(outcomes).select("page_id", "requesturl")


def _routed_outputs(spark, sf_dir):
    rules = [rule_contains("requesturl", "example", POLICY)]
    routed = route_detect(_damaged_pages(spark, sf_dir), rules, fields=PAGE)
    return routed.select(
        "output", F.col("offset").alias("page_id"), F.coalesce("pos", F.lit(-1)).alias("pos")
    )


def _stored(spark: SparkSession, envelopes: DataFrame, **options) -> str:
    path = scratch(spark, "envelopes")
    envelopes.write.options(**options).parquet(path)
    return path


def _streamed(spark: SparkSession, envelopes: DataFrame, route, **options) -> str:
    """Store envelopes, run them through the streaming job, and return the folder of its output."""
    stream = read_envelopes(spark, path=_stored(spark, envelopes), streaming=True)
    target = scratch(spark, "violations")
    query = run_detection(
        route(stream),
        FileSink(target),
        checkpoint=scratch(spark, "progress"),
        available_now=True,
        **options,
    )
    query.awaitTermination()
    return target


def _stream_detect_url(spark, sf_dir):
    rules = [rule_contains("requesturl", "example.com", POLICY)]
    target = _streamed(
        spark,
        pack_table(_pages(spark, sf_dir), "gzip"),
        lambda stream: route_detect(stream, rules, fields=PAGE),
    )
    published = spark.read.parquet(target).where(F.col("output") == "violations")
    fields = PAGE + ", violations array<struct<policyId:bigint>>"
    return _flat(_reread(published, fields, "gzip"), "page_id", "requesturl")


def _stream_promote(spark, sf_dir):
    target = _streamed(
        spark,
        pack_table(_events_with_custom(spark, sf_dir), "gzip", 100),
        lambda stream: route_promote(stream, out_codec="snappy"),
    )
    published = spark.read.parquet(target).where(F.col("output") == "violations")
    return _flat(_reread(published, PUBLISHED + CUSTOM, "snappy"), *WHOLE, _seconds(), _custom())


def _stream_two_sinks(spark, sf_dir):
    rules = [rule_contains("requesturl", "example", POLICY)]
    bad = scratch(spark, "quarantine")
    target = _streamed(
        spark,
        _damaged_pages(spark, sf_dir),
        lambda stream: route_detect(stream, rules, fields=PAGE),
        quarantine_sink=FileSink(bad),
    )
    reason = F.coalesce("reason", F.lit("")).alias("reason")
    columns = ("output", F.col("offset").alias("page_id"), reason)
    flagged = spark.read.parquet(target).select(*columns)
    return flagged.unionByName(spark.read.parquet(bad).select(*columns))


def _detect_many_rules(spark, sf_dir):
    kinds = ("view", "click", "purchase", "sign", "err", "i", "e")
    rules = [
        Rule(8000 + 10 * n + k, F.contains("event_type", F.lit(kind)) & (F.col("event_id") % 10 == n))
        for n in range(10)
        for k, kind in enumerate(kinds)
    ]
    envelopes = pack_table(_table(spark, sf_dir, "events"), "gzip", 100)
    return _flat(detect(envelopes, rules, fields=EVENT), "event_id", "event_type")


def _listed(envelopes: DataFrame) -> DataFrame:
    rules = [rule_contains("event_type", "err", POLICY), rule_contains("event_type", "view", 17)]
    return route_detect(envelopes, rules, fields=EVENT, form="lists", max_message_bytes=2_000)


def _detect_lists(spark, sf_dir):
    routed = _listed(pack_table(_table(spark, sf_dir, "events"), "gzip", 100))
    published = routed.where(F.col("output") == "violations")
    return _flat(_reread(published, PUBLISHED, "gzip"), *WHOLE, _seconds())


def _stream_detect_lists(spark, sf_dir):
    target = _streamed(spark, pack_table(_table(spark, sf_dir, "events"), "gzip", 100), _listed)
    published = spark.read.parquet(target).where(F.col("output") == "violations")
    return _flat(_reread(published, PUBLISHED, "gzip"), *WHOLE, _seconds())


def _stream_restart(spark, sf_dir):
    """Half of the envelopes, a stop, then the rest with two sinks on the path of the first run."""
    rules = [rule_contains("requesturl", "example", POLICY)]
    envelopes = _damaged_pages(spark, sf_dir)
    source, target, progress = (scratch(spark, n) for n in ("envelopes", "violations", "progress"))
    halves = [envelopes.where(F.col("offset") % 2 == k) for k in range(2)]
    for half, more in zip(halves, ({}, {"quarantine_sink": FileSink(target)})):
        half.write.mode("append").parquet(source)
        stream = read_envelopes(spark, path=source, streaming=True)
        run_detection(
            route_detect(stream, rules, fields=PAGE),
            FileSink(target),
            progress,
            available_now=True,
            **more,
        ).awaitTermination()
    reason = F.coalesce("reason", F.lit("")).alias("reason")
    return spark.read.parquet(target).select("output", F.col("offset").alias("page_id"), reason)


def _quarantine_bytes(spark, sf_dir):
    """Whether what is set aside is what came in: whole envelopes by digest, elements by text."""
    envelopes = _damaged_pages(spark, sf_dir)
    outcomes = decode_outcomes(decompress_envelopes(envelopes), PAGE)
    came = envelopes.select("offset", F.sha2("value", 256).alias("came"))
    kept = quarantine_of(outcomes).join(came, "offset")
    whole = F.col("pos").isNull()
    return kept.select(
        F.col("offset").alias("page_id"),
        F.coalesce("pos", F.lit(-1)).alias("pos"),
        F.when(whole, F.sha2("value", 256) == F.col("came")).alias("same"),
        F.when(~whole, F.col("value").cast("string")).alias("element"),
    )


def _stream_written_bytes(spark, sf_dir):
    """What two sinks wrote: published events read again whole, and set-aside bytes held against what came."""
    rules = [rule_contains("requesturl", "example", POLICY)]
    envelopes = _damaged_pages(spark, sf_dir)
    bad = scratch(spark, "quarantine")
    target = _streamed(
        spark,
        envelopes,
        lambda stream: route_detect(stream, rules, fields=PAGE),
        quarantine_sink=FileSink(bad),
    )
    fields = PAGE + ", html string, violations array<struct<policyId:bigint>>"
    published = _reread(spark.read.parquet(target), fields, "gzip").select(
        F.lit("violations").alias("output"),
        "page_id",
        F.lit(-1).alias("pos"),
        F.concat("requesturl", F.lit(" "), F.md5("html"), F.lit(" "), F.to_json("violations")).alias("content"),
    )
    came = envelopes.select("offset", F.md5("value").alias("came"))
    whole = F.when(F.md5("value") == F.col("came"), "as it came").otherwise("changed")
    aside = spark.read.parquet(bad).join(came, "offset").select(
        F.lit("quarantine").alias("output"),
        F.col("offset").alias("page_id"),
        F.coalesce("pos", F.lit(-1)).alias("pos"),
        F.when(F.col("pos").isNull(), whole).otherwise(F.col("value").cast("string")).alias("content"),
    )
    return published.unionByName(aside)


def _failing(envelopes: DataFrame) -> DataFrame:
    """Rules of which one raises on every seventh event, and another on every eleventh."""
    rules = [
        Rule(7001, F.col("code").cast("int") > 50),
        python_rule(lambda n: 100 // (n % 11) > 20, ["event_id"], 7002),
        rule_contains("event_type", "err", 7003),
        Rule(7004, F.col("code").cast("int") % 10 == 0),
    ]
    fields = EVENT + ", code string"
    return route_detect(envelopes, rules, fields=fields, out_codec="none", on_rule_error="quarantine")


def _coded_events(spark, sf_dir):
    code = F.when(F.col("event_id") % 7 == 3, F.lit("n/a")).otherwise(F.col("user_id").cast("string"))
    return pack_table(_table(spark, sf_dir, "events").withColumn("code", code), "gzip", 100)


def _judged(routed: DataFrame) -> DataFrame:
    """Event, policies and reason of every output row."""
    text = F.col("value").cast("string")
    event = F.when(F.col("output") == "violations", F.get_json_object(text, "$[0]")).otherwise(text)
    found = F.from_json(F.get_json_object(event, "$.violations"), "array<struct<policyId:bigint>>")
    policies = F.array_join(F.transform(found, lambda v: v["policyId"].cast("string")), ",")
    return routed.select(
        "output",
        F.get_json_object(event, "$.event_id").cast("bigint").alias("event_id"),
        F.coalesce(policies, F.lit("")).alias("policies"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )


def _detect_failing_rule(spark, sf_dir):
    return _judged(_failing(_coded_events(spark, sf_dir)))


def _stream_failing_rule(spark, sf_dir):
    return _judged(spark.read.parquet(_streamed(spark, _coded_events(spark, sf_dir), _failing)))


_LETTERS = "acdehilmnoprt"


def _detect_token_rules(spark, sf_dir):
    """A rule for each of 2,197 syllables, between two plain ones."""
    syllables = [a + b + c for a in _LETTERS for b in _LETTERS for c in _LETTERS]
    rules = [
        rule_contains("requesturl", "example.com", 1),
        TokenRules("requesturl", [(t, 10_000 + n) for n, t in enumerate(syllables)]),
        rule_contains("requesturl", "/en/", 2),
    ]
    flagged = detect(pack_table(_pages(spark, sf_dir), "gzip"), rules, fields=PAGE)
    return flagged.select("page_id", F.posexplode("violations").alias("nth", "violation")).select(
        "page_id", "nth", F.col("violation.policyId").alias("policy_id")
    )


def _stream_rule_table(spark, sf_dir):
    """Half of the pages under one rule, the rest under two more, added while the stream runs."""
    odd = F.col("page_id") % 2 == 1
    source, table, target = (scratch(spark, n) for n in ("halves", "rules", "violations"))

    def half(which: Column) -> None:
        pages = _pages(spark, sf_dir).where(which)
        pack_table(pages, "gzip").write.mode("append").parquet(source)

    def add(*rules: tuple) -> None:
        schema = "policy_id bigint, field string, token string, expression string"
        spark.createDataFrame(rules, schema).write.mode("append").parquet(table)

    half(~odd)
    add((101, "requesturl", "example.com", None))
    query = run_detection(
        read_envelopes(spark, path=source, streaming=True),
        FileSink(target),
        scratch(spark, "progress"),
        route=lambda batch: route_detect(batch, read_rules(batch.sparkSession, table), fields=PAGE),
    )
    try:
        query.processAllAvailable()
        add((102, "requesturl", "utm_source", None), (103, None, None, "length(requesturl) > 50"))
        half(odd)
        query.processAllAvailable()
    finally:
        query.stop()
    fields = PAGE + ", violations array<struct<policyId:bigint>>"
    return _flat(_reread(spark.read.parquet(target), fields, "gzip"), "page_id", "requesturl")


def _across(envelopes: DataFrame) -> DataFrame:
    rules = [rule_contains("event_type", "err", POLICY), rule_contains("event_type", "view", 17)]
    return route_detect(envelopes, rules, fields=EVENT, form="partitions", max_message_bytes=20_000)


def _detect_partition_lists(spark, sf_dir):
    routed = _across(pack_table(_table(spark, sf_dir, "events"), "gzip", 10))
    published = routed.where(F.col("output") == "violations")
    return _flat(_reread(published, PUBLISHED, "gzip"), *WHOLE, _seconds())


def _stream_partition_lists(spark, sf_dir):
    target = _streamed(spark, pack_table(_table(spark, sf_dir, "events"), "gzip", 10), _across)
    published = spark.read.parquet(target).where(F.col("output") == "violations")
    return _flat(_reread(published, PUBLISHED, "gzip"), *WHOLE, _seconds())


def _url_rules(batch: DataFrame) -> DataFrame:
    return route_detect(batch, [rule_contains("requesturl", "example.com", POLICY)], fields=PAGE)


def _published_urls(published: DataFrame) -> DataFrame:
    fields = PAGE + ", violations array<struct<policyId:bigint>>"
    published = published.where(F.col("output") == "violations")
    return _flat(_reread(published, fields, "gzip"), "page_id", "requesturl")


def _stream_positions(spark, sf_dir):
    """A job over the first envelopes of each partition, and another that goes on from its positions."""
    stored = _stored(spark, pack_table(_pages(spark, sf_dir), "gzip", 4))
    store = scratch(spark, "positions")
    early = scratch(spark, "early")
    first = spark.read.parquet(stored).where(F.col("offset") % (1 << 33) < 7)
    first.write.parquet(early)
    outputs = []
    for source in (early, stored):
        stream = read_envelopes(spark, path=source, streaming=True)
        outputs.append(scratch(spark, "violations"))
        run_detection(
            between(stream, PositionStore(spark, store).load()),
            FileSink(outputs[-1]),
            scratch(spark, "progress"),
            available_now=True,
            route=_url_rules,
            positions=store,
        ).awaitTermination()
    # A job that finds nothing new leaves no files to take a schema from.
    both = [spark.read.schema("value binary, output string").parquet(o) for o in outputs]
    return _published_urls(both[0].union(both[1]))


# Envelopes of a partition where a topic is made with a rate per partition, and most tasks that make it.
_BLOCK, _TASKS = 2_500, 100_000


def _detect_capped(spark, sf_dir):
    """Batches that take a stated number of envelopes of each partition, until all are read."""
    # A topic gets more partitions as its traffic grows, so a rate per partition keeps up with it.
    row = F.col("offset") % (1 << 33)
    block = (row / _BLOCK).cast("int") * _TASKS + F.col("partition")
    envelopes = pack_table(_pages(spark, sf_dir), "gzip", 4).withColumn("partition", block)
    # Pages of few rows, so that a batch reads its own envelopes of a file and not the whole file.
    stored = _stored(spark, envelopes, **{"parquet.page.row.count.limit": 100})
    envelopes, target = read_envelopes(spark, path=stored), scratch(spark, "violations")
    start = collect_positions(first_positions(envelopes))
    latest = collect_positions(next_positions(envelopes))
    for begin, end in capped_batches(start, latest, per_second=5, seconds=5):
        write_violations(_url_rules(between(envelopes, begin, end)), FileSink(target))
    return _published_urls(spark.read.parquet(target))


def _stream_drop_repeats(spark, sf_dir):
    """Messages published twice, by a job and by its replay, read as a stream that drops repeats."""
    envelopes = _stored(spark, pack_table(_table(spark, sf_dir, "events"), "gzip", 100))
    target, once = scratch(spark, "published"), scratch(spark, "once")
    rules = [rule_contains("event_type", "err", POLICY)]
    for _ in range(2):
        stream = read_envelopes(spark, path=envelopes, streaming=True)
        run_detection(
            route_detect(stream, rules, fields=EVENT),
            FileSink(target),
            scratch(spark, "progress"),
            available_now=True,
        ).awaitTermination()
    published = (
        spark.readStream.schema("key binary, value binary")
        .parquet(f"{target}/query=*/batch=*/output=violations")
        .withColumn("timestamp", F.lit("2026-01-01").cast("timestamp"))
    )
    writer = drop_repeats(published).writeStream.trigger(availableNow=True)
    writer.option("checkpointLocation", scratch(spark, "progress")).start(once).awaitTermination()
    return _flat(_reread(spark.read.parquet(once), PUBLISHED, "gzip"), *WHOLE, _seconds())


QUERIES: dict[str, Query] = {
    "decode_none": _decode("none"),
    "decode_gzip": _decode("gzip"),
    "decode_snappy": _decode("snappy"),
    "detect_url": _detect_url,
    "detect_multi_rule": _detect_multi_rule,
    "detect_event_type": _detect_event_type,
    "detect_sparse_field": _detect_sparse_field,
    "detect_text": _detect_text,
    "detect_custom_logic": _detect_custom_logic,
    "detect_udf_rule": _detect_udf_rule,
    "template_audit": _template_audit,
    "promote_custom": _promote_custom,
    "promote_missing": _promote_missing,
    "promote_republish": _promote_republish,
    "republish_roundtrip": _republish_roundtrip,
    "replace_violations": _replace_violations,
    "pack_roundtrip": _pack_roundtrip,
    "quarantine_rows": _quarantine_rows,
    "quarantine_counts": _quarantine_counts,
    "quarantine_survivors": _quarantine_survivors,
    "routed_outputs": _routed_outputs,
    "stream_detect_url": _stream_detect_url,
    "stream_promote": _stream_promote,
    "stream_two_sinks": _stream_two_sinks,
    "detect_many_rules": _detect_many_rules,
    "detect_lists": _detect_lists,
    "stream_detect_lists": _stream_detect_lists,
    "stream_restart": _stream_restart,
    "quarantine_bytes": _quarantine_bytes,
    "stream_written_bytes": _stream_written_bytes,
    "detect_failing_rule": _detect_failing_rule,
    "stream_failing_rule": _stream_failing_rule,
    "detect_token_rules": _detect_token_rules,
    "stream_rule_table": _stream_rule_table,
    "detect_partition_lists": _detect_partition_lists,
    "stream_partition_lists": _stream_partition_lists,
    "stream_positions": _stream_positions,
    "detect_capped": _detect_capped,
    "stream_drop_repeats": _stream_drop_repeats,
}

_DECODE_SQL = "SELECT page_id, url, md5(html) AS html_md5 FROM pages"

_DETECT_URL_SQL = f"""
SELECT page_id, url AS requesturl, CAST({POLICY} AS BIGINT) AS policy_id
FROM pages WHERE contains(url, 'example.com')"""

_MATCHES_SQL = " UNION ALL ".join(
    f"SELECT page_id, url AS requesturl, {n} AS rule, CAST({policy} AS BIGINT) AS policy_id "
    f"FROM pages WHERE contains(url, '{token}')"
    for n, (token, policy) in enumerate(PAGE_RULES)
)

_WHOLE_SQL = "event_id, event_type, user_id, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"

_PUBLISHED_SQL = f"""
SELECT {_WHOLE_SQL}, CAST({POLICY} AS BIGINT) AS policy_id
FROM events WHERE contains(event_type, 'err')"""

_LISTED_SQL = f"""{_PUBLISHED_SQL}
UNION ALL SELECT {_WHOLE_SQL}, CAST(17 AS BIGINT) FROM events WHERE contains(event_type, 'view')"""

_CUSTOM_SQL = "CAST(json_extract(props, '$.k') AS BIGINT)"

_PROMOTED_SQL = (
    f"SELECT {_WHOLE_SQL}, {_CUSTOM_SQL} AS custom_id, {_CUSTOM_SQL} AS policy_id FROM events"
)

_DAMAGE_SQL = """
SELECT page_id, -1 AS pos, 'decompress' AS reason FROM pages WHERE page_id % 7 IN (0, 1)
UNION ALL SELECT page_id, -1, 'parse' FROM pages WHERE page_id % 7 = 2
UNION ALL SELECT page_id, -1, 'not_array' FROM pages WHERE page_id % 7 = 3
UNION ALL SELECT page_id, 1, 'not_object' FROM pages WHERE page_id % 7 = 4
UNION ALL SELECT page_id, 2, 'not_object' FROM pages WHERE page_id % 7 = 4"""

_FLAGGED_SQL = "FROM pages WHERE page_id % 7 >= 4 AND contains(url, 'example')"

_FAILING_SQL = """
WITH judged AS (
    SELECT event_id, event_id % 7 = 3 AS f1, event_id % 11 = 0 AS f2, user_id > 50 AS m1,
           event_id % 11 BETWEEN 1 AND 4 AS m2, contains(event_type, 'err') AS m3, user_id % 10 = 0 AS m4
    FROM events
)
SELECT 'quarantine' AS output, event_id, '' AS policies,
       'rule:' || concat_ws(',', CASE WHEN f1 THEN '7001' END, CASE WHEN f2 THEN '7002' END,
                            CASE WHEN f1 THEN '7004' END) AS reason
FROM judged WHERE f1 OR f2
UNION ALL
SELECT 'violations', event_id,
       concat_ws(',', CASE WHEN m1 THEN '7001' END, CASE WHEN m2 THEN '7002' END,
                 CASE WHEN m3 THEN '7003' END, CASE WHEN m4 THEN '7004' END), ''
FROM judged WHERE NOT f1 AND NOT f2 AND (m1 OR m2 OR m3 OR m4)"""

ORACLE_SQL: dict[str, str] = {
    "decode_none": _DECODE_SQL,
    "decode_gzip": _DECODE_SQL,
    "decode_snappy": _DECODE_SQL,
    "detect_url": _DETECT_URL_SQL,
    "detect_multi_rule": f"""
SELECT page_id, requesturl, policy_id,
       CAST(row_number() OVER (PARTITION BY page_id ORDER BY rule) - 1 AS INTEGER) AS nth
FROM ({_MATCHES_SQL})""",
    "detect_event_type": f"""
SELECT event_id, event_type, CAST({POLICY} AS BIGINT) AS policy_id
FROM events WHERE contains(event_type, 'err')""",
    "detect_sparse_field": f"""
SELECT event_id, event_type, CAST({POLICY} AS BIGINT) AS policy_id
FROM events WHERE event_id % 3 <> 0 AND contains(event_type, 'err')""",
    "detect_text": f"""
SELECT doc_id, CAST(length(text) AS INTEGER) AS n, CAST({POLICY} AS BIGINT) AS policy_id
FROM documents WHERE contains(text, 'License')
UNION ALL
SELECT doc_id, CAST(length(text) AS INTEGER), CAST(17 AS BIGINT)
FROM documents WHERE contains(text, 'sch ')""",
    "detect_custom_logic": """
SELECT event_id, CAST(7001 AS BIGINT) AS policy_id
FROM events WHERE event_type = 'purchase' AND value > 150
UNION ALL
SELECT event_id, CAST(7002 AS BIGINT) FROM events WHERE user_id < 20""",
    "detect_udf_rule": """
SELECT page_id, url AS requesturl, CAST(8001 AS BIGINT) AS policy_id
FROM pages WHERE length(url) > 50""",
    "template_audit": """
SELECT count(event_id) AS decoded, CAST(0 AS BIGINT) AS violating FROM events""",
    "promote_custom": f"SELECT event_id, {_CUSTOM_SQL} AS policy_id FROM events",
    "promote_missing": f"""
SELECT {_WHOLE_SQL}, CASE WHEN event_type = 'view' THEN {_CUSTOM_SQL} ELSE -1 END AS custom_id,
       CASE WHEN event_type = 'view' THEN {_CUSTOM_SQL} ELSE -1 END AS policy_id
FROM events""",
    "promote_republish": _PROMOTED_SQL,
    "republish_roundtrip": _PUBLISHED_SQL,
    "replace_violations": f"""
SELECT {_WHOLE_SQL}, 1 AS n, CAST({POLICY} AS BIGINT) AS policy_id
FROM events WHERE contains(event_type, 'sign')""",
    "pack_roundtrip": """
SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents WHERE n_chars > 0""",
    "quarantine_rows": _DAMAGE_SQL,
    "quarantine_counts": f"SELECT reason, count(*) AS n FROM ({_DAMAGE_SQL}) GROUP BY reason",
    "quarantine_survivors": """
SELECT page_id, url AS requesturl FROM pages WHERE page_id % 7 >= 4""",
    "routed_outputs": f"""
SELECT 'violations' AS output, page_id, 0 AS pos {_FLAGGED_SQL}
UNION ALL SELECT 'quarantine', page_id, pos FROM ({_DAMAGE_SQL})""",
    "stream_detect_url": _DETECT_URL_SQL,
    "stream_promote": _PROMOTED_SQL,
    "stream_two_sinks": f"""
SELECT 'violations' AS output, page_id, '' AS reason {_FLAGGED_SQL}
UNION ALL SELECT 'quarantine', page_id, reason FROM ({_DAMAGE_SQL})""",
    "detect_many_rules": """
SELECT event_id, event_type, 8000 + 10 * (event_id % 10) + k AS policy_id
FROM events, (VALUES (0, 'view'), (1, 'click'), (2, 'purchase'), (3, 'sign'), (4, 'err'), (5, 'i'),
              (6, 'e')) AS kinds(k, kind)
WHERE contains(event_type, kind)""",
    "detect_lists": _LISTED_SQL,
    "stream_detect_lists": _LISTED_SQL,
    "stream_restart": f"""
SELECT 'violations' AS output, page_id, '' AS reason {_FLAGGED_SQL}
UNION ALL SELECT 'quarantine', page_id, reason FROM ({_DAMAGE_SQL})""",
    "quarantine_bytes": """
SELECT page_id, -1 AS pos, true AS same, NULL::VARCHAR AS element FROM pages WHERE page_id % 7 < 4
UNION ALL SELECT page_id, 1, NULL, '7' FROM pages WHERE page_id % 7 = 4
UNION ALL SELECT page_id, 2, NULL, '"text"' FROM pages WHERE page_id % 7 = 4""",
    "stream_written_bytes": f"""
SELECT 'violations' AS output, page_id, -1 AS pos,
       url || ' ' || md5(html) || ' [{{"policyId":{POLICY}}}]' AS content {_FLAGGED_SQL}
UNION ALL SELECT 'quarantine', page_id, -1, 'as it came' FROM pages WHERE page_id % 7 < 4
UNION ALL SELECT 'quarantine', page_id, 1, '7' FROM pages WHERE page_id % 7 = 4
UNION ALL SELECT 'quarantine', page_id, 2, '"text"' FROM pages WHERE page_id % 7 = 4""",
    "detect_failing_rule": _FAILING_SQL,
    "stream_failing_rule": _FAILING_SQL,
    "detect_token_rules": f"""
WITH letters AS (
    SELECT unnest(string_split('{_LETTERS}', '')) AS x, generate_subscripts(string_split('{_LETTERS}', ''), 1) - 1 AS i
), rules AS (
    SELECT a.x || b.x || c.x AS token, 10000 + 169 * a.i + 13 * b.i + c.i AS policy_id,
           1 + 169 * a.i + 13 * b.i + c.i AS place
    FROM letters a, letters b, letters c
    UNION ALL SELECT 'example.com', 1, 0
    UNION ALL SELECT '/en/', 2, 9999
)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS INTEGER) AS nth,
       CAST(policy_id AS BIGINT) AS policy_id
FROM pages JOIN rules ON contains(url, token)""",
    "stream_rule_table": """
SELECT page_id, url AS requesturl, CAST(101 AS BIGINT) AS policy_id
FROM pages WHERE contains(url, 'example.com')
UNION ALL
SELECT page_id, url, CAST(102 AS BIGINT) FROM pages WHERE page_id % 2 = 1 AND contains(url, 'utm_source')
UNION ALL
SELECT page_id, url, CAST(103 AS BIGINT) FROM pages WHERE page_id % 2 = 1 AND length(url) > 50""",
    "detect_partition_lists": _LISTED_SQL,
    "stream_partition_lists": _LISTED_SQL,
    "stream_positions": _DETECT_URL_SQL,
    "detect_capped": _DETECT_URL_SQL,
    "stream_drop_repeats": _PUBLISHED_SQL,
}
