"""Rules that fail, rules by the thousand, rules from tables, lists across envelopes."""

import itertools
import random
import tracemalloc

import pyarrow as pa
import pytest
from envelopes import envelopes, packed, texts
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

import breachline as bl

FIELDS = "n bigint, code string, requesturl string"


def events(*codes):
    return "[" + ",".join(f'{{"n":{i},"code":"{c}","requesturl":"u{c}"}}' for i, c in enumerate(codes)) + "]"


def failing_rules():
    # Inside, so that it travels to the workers.
    def odd(n):
        if n == 1:
            raise RuntimeError("no such number")
        return n % 2 == 1

    number = F.col("code").cast("int")
    return [
        bl.Rule(1, number > 5),
        bl.Rule(2, number % 2 == 0),
        bl.python_rule(odd, ["n"], 3),
        bl.Rule(4, F.raise_error(F.col("code")).cast("boolean") & (F.col("code") == "9")),
        bl.rule_contains("requesturl", "8", 5),
    ]


def judged(spark, rules, **options):
    outcomes = bl.decode_outcomes(texts(spark, events("9", "8", "x", "1", "6"), "bad"), FIELDS)
    return bl.apply_rules(outcomes, rules, unless=F.col("reason").isNotNull(), **options)


def listed(frame):
    rows = frame.where(F.col("n").isNotNull()).orderBy("n").collect()
    return [(r.n, r.reason, None if r.violations is None else [v.policyId for v in r.violations]) for r in rows]


def test_an_event_on_which_rules_fail_is_set_aside_and_its_neighbours_go_on(spark):
    rules = [r for r in failing_rules() if r.policy_id != 4]
    got = listed(judged(spark, rules, on_error="quarantine"))
    assert got == [
        (0, None, [1]),
        (1, "rule:3", None),
        (2, "rule:1,2", None),
        (3, None, [3]),
        (4, None, [1, 2]),
    ]


def test_a_rule_that_always_raises_sets_all_aside(spark):
    got = listed(judged(spark, failing_rules(), on_error="quarantine"))
    assert [r[1] for r in got] == ["rule:4", "rule:3,4", "rule:1,2,4", "rule:4", "rule:4"]


def test_skipped_rules_do_not_match(spark):
    got = listed(judged(spark, failing_rules(), on_error="skip"))
    assert [r[1:] for r in got] == [(None, [1]), (None, [1, 2, 5]), (None, []), (None, [3]), (None, [1, 2])]


@pytest.mark.parametrize("rule", range(3))
def test_without_a_word_the_job_fails(spark, rule):
    with pytest.raises(PySparkException):
        judged(spark, [failing_rules()[rule]]).collect()


def test_the_route_keeps_the_text_of_what_failed(spark):
    incoming = envelopes(spark, [packed(events("9", "x", "6")), packed("bad")])
    observed = Observation()
    rules = [bl.Rule(1, F.col("code").cast("int") > 5)]
    routed = bl.route_detect(
        incoming, rules, fields=FIELDS, out_codec="none", on_rule_error="quarantine", counts=observed
    )
    got = sorted((r.output, r.pos, r.reason, bytes(r.value)) for r in routed.fillna(-1, ["pos"]).collect())
    aside = b'{"code":"x","n":1,"requesturl":"ux"}'
    assert [g[:3] for g in got] == [
        ("quarantine", -1, "parse"),
        ("quarantine", 1, "rule:1"),
        ("violations", 0, None),
        ("violations", 2, None),
    ]
    assert got[1][3] == aside
    assert observed.get["events"] == 3 and observed.get["violating"] == 2 and observed.get["rule"] == 1


def test_only_decoded_rows_can_be_set_aside(spark):
    plain = spark.createDataFrame([("1",)], "code string")
    with pytest.raises(ValueError):
        bl.apply_rules(plain, failing_rules(), on_error="quarantine")
    with pytest.raises(ValueError):
        bl.apply_rules(plain, [], on_error="never")


def test_stopping_at_bad_text_is_not_stopping_at_failed_rules(spark):
    incoming = envelopes(spark, [packed(events("x"))])
    rules = [bl.Rule(1, F.col("code").cast("int") > 5)]
    routed = bl.route_detect(incoming, rules, fields=FIELDS, on_bad="fail", on_rule_error="quarantine")
    assert [r.reason for r in routed.collect()] == ["rule:1"]


def contained(rows, tokens):
    return [[p for t, p in tokens if text is not None and t in text] for text in rows]


def test_literals_as_one_by_one(spark):
    rng = random.Random(5)
    word = lambda most: "".join(rng.choice("abé%_\U0001f600") for _ in range(rng.randrange(most)))
    tokens = [(word(5), rng.randrange(1 << 40)) for _ in range(400)] + [("ab", 7), ("ab", 8), ("", 9)]
    rows = [None, "", "ab", *(word(40) for _ in range(60))]
    frame = spark.createDataFrame(list(enumerate(rows)), "i int, requesturl string")
    sets = [bl.TokenRules("requesturl", tokens)]
    got = bl.apply_rules(frame, sets).orderBy("i").collect()
    assert [[v.policyId for v in r.violations] for r in got] == contained(rows, tokens)
    only = bl.apply_rules(frame, sets, only_violating=True).count()
    assert only == sum(map(bool, contained(rows, tokens)))


def test_sets_among_plain_rules_keep_the_order(spark):
    frame = spark.createDataFrame([("abc",), ("x",), (None,)], "requesturl string")
    plain = [bl.rule_contains("requesturl", t, i) for i, t in enumerate("axc")]
    sets = [bl.TokenRules("requesturl", [("b", 11), ("c", 10)]), bl.TokenRules("requesturl", [])]
    for rules in itertools.permutations([*plain, *sets], 5):
        want = []
        for text in ("abc", "x", None):
            want.append([])
            for r in rules:
                if isinstance(r, bl.TokenRules):
                    want[-1] += contained([text], r.tokens)[0]
                elif text is not None and "axc"[r.policy_id] in text:
                    want[-1].append(r.policy_id)
        if rules[0] is plain[1] or rules[-1] is sets[1]:  # a third of all orders
            got = bl.apply_rules(frame, rules).collect()
            assert [[v.policyId for v in r.violations] for r in got] == want
            break


def test_many_literals_are_one_step_of_the_plan(spark):
    frame = spark.createDataFrame([("abc",)], "requesturl string")
    rules = [bl.TokenRules("requesturl", [(f"t{i}", i) for i in range(2000)])]
    plan = bl.apply_rules(frame, rules, only_violating=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and len(plan) < 20_000


TABLE = "policy_id bigint, field string, token string, expression string"


def test_rules_of_a_table(spark):
    table = spark.createDataFrame(
        [
            (5, None, None, "n > 2 AND code = '1'"),
            (2, "requesturl", "u", None),
            (1, "requesturl", "9", None),
            (3, "code", "6", None),
        ],
        TABLE,
    )
    rules = bl.rules_of(table)
    assert [type(r).__name__ for r in rules] == ["TokenRules", "TokenRules", "Rule"]
    assert [r[2] for r in listed(judged(spark, rules))] == [[1, 2], [2], [2], [2, 5], [3, 2]]
    assert bl.rules_of(table.drop("expression").limit(0)) == []


@pytest.mark.parametrize(
    "row", [(None, "a", "b", None), (1, None, "b", None), (1, "a", None, None), (1, "a", "b", "true"), (1, None, None, None)]
)
def test_unclear_rows_are_refused(spark, row):
    with pytest.raises(ValueError):
        bl.rules_of(spark.createDataFrame([row], TABLE))


def test_tables_beyond_the_bounds_are_refused(spark):
    table = spark.createDataFrame([(i, "f", "token", None) for i in range(5)], TABLE)
    with pytest.raises(ValueError):
        bl.rules_of(table, most_rules=4)
    with pytest.raises(ValueError):
        bl.rules_of(table, most_bytes=29)
    assert len(bl.rules_of(table, 5, 30)[0].tokens) == 5


def test_a_rule_added_between_batches_takes_effect(spark, tmp_path):
    source, table, out = (str(tmp_path / n) for n in ("in", "rules", "out"))

    def arrive(offset):
        rows = envelopes(spark, [packed(events("9", "8"))]).withColumn("offset", F.lit(offset).cast("long"))
        rows.coalesce(1).write.mode("append").parquet(source)

    def add(*rule):
        spark.createDataFrame([rule], TABLE).write.mode("append").parquet(table)

    arrive(0)
    add(1, "code", "9", None)
    seen = []
    query = bl.run_detection(
        bl.read_envelopes(spark, path=source, streaming=True),
        bl.FileSink(out),
        str(tmp_path / "progress"),
        route=lambda batch: bl.route_detect(
            batch, bl.read_rules(batch.sparkSession, table), fields=FIELDS, out_codec="none"
        ),
        on_batch=lambda rows, n: seen.append((n, rows.count())),
    )
    try:
        query.processAllAvailable()
        add(2, None, None, "n = 1")
        arrive(1)
        query.processAllAvailable()
    finally:
        query.stop()
    got = spark.read.parquet(out).select("offset", "pos").orderBy("offset", "pos").collect()
    assert [tuple(r) for r in got] == [(0, 0), (1, 0), (1, 1)]
    assert seen == [(0, 1), (1, 2)]


def across(spark, values, room=900_000, **options):
    routed = bl.route_detect(
        envelopes(spark, values).coalesce(1),
        [bl.rule_contains("requesturl", "u", 1)],
        fields=FIELDS,
        out_codec="none",
        form="partitions",
        max_message_bytes=room,
        **options,
    )
    return [(r.output, r.offset, r.pos, bytes(r.key), bytes(r.value)) for r in routed.collect()]


def test_lists_go_on_across_envelopes_and_what_is_set_aside_keeps_its_place(spark):
    values = [packed(events("1", "2")), packed("bad"), packed("[]"), packed(events("3")), packed('[7,{"requesturl":"u"}]')]
    got = across(spark, values)
    assert [g[:3] for g in got] == [("quarantine", 1, None), ("quarantine", 4, 0), ("violations", 0, 0)]
    assert got[2][3] == b"t/0/0/0" and got[2][4].count(b'"violations"') == 4
    assert got[0][4] == values[1] and got[1][4] == b"7"


def test_lists_across_envelopes_are_cut_at_their_bound(spark):
    one = len(across(spark, [packed(events("1"))])[0][4])
    values = [packed(events("1")) for _ in range(7)]
    for room, want in ((1, [0, 1, 2, 3, 4, 5, 6]), (2 * one, [0, 2, 4, 6]), (7 * one, [0])):
        got = across(spark, values, room)
        assert [g[1] for g in got] == want
        assert all(len(g[4]) <= max(room, one) for g in got)


def test_batches_of_arrow_do_not_show(spark):
    values = [packed(events("1", "2", "3")) if i % 3 else packed("bad") for i in range(20)]
    whole = across(spark, values, 400)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "4"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert across(spark, values, 400) == whole
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_lists_across_envelopes_do_not_shuffle(spark):
    routed = bl.route_detect(
        envelopes(spark, [packed(events("1"))]), [bl.rule_contains("requesturl", "u", 1)], form="partitions"
    )
    assert "Exchange" not in routed._jdf.queryExecution().executedPlan().toString()


def test_a_batch_done_again_leaves_nothing_of_its_first_attempt(spark, tmp_path):
    from breachline.sinks.violations import write_batch

    rows = bl.route_detect(
        envelopes(spark, [packed(events("1")), packed("bad")]), [bl.rule_contains("requesturl", "u", 1)], fields=FIELDS
    ).cache()
    sink = bl.FileSink(str(tmp_path / "out"))
    outputs = lambda: sorted(r.output for r in spark.read.parquet(sink.path).collect())
    write_batch(rows, sink, 0)
    assert outputs() == ["quarantine", "violations"]
    write_batch(rows.where("output = 'violations'"), sink, 0)
    assert outputs() == ["violations"]
    write_batch(rows.where("output = 'quarantine'"), sink, 0, output="quarantine")
    assert outputs() == ["quarantine", "violations"]
    write_batch(rows.where("false"), sink, 0, output="quarantine")
    assert outputs() == ["violations"]


def test_python_rule_holds_one_row_at_a_time(spark, monkeypatch):
    class Captured:
        def __init__(self, judge, kind):
            self.judge = judge

        def asNondeterministic(self):
            return lambda *columns: self.judge

    monkeypatch.setattr(F, "arrow_udf", Captured)
    judge = bl.python_rule(lambda text, n: 1 // n > 0 and text[0] == "a", ["text", "n"], 7).predicate
    texts_, numbers = pa.array([chr(97 + i % 2) * (64 << 10) for i in range(256)]), pa.array([1, 1, 0, None] * 64)
    tracemalloc.start()
    try:
        found = judge(texts_, numbers)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.to_pylist() == [True, False, None, None] * 64
    assert most < 4 << 20
