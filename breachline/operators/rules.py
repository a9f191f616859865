"""Detection rules: which policies an event violates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.events import violation_list
from ..functions.guard import null_if_raised
from ..functions.tokens import token_hits
from ..schemas import FAILED_RULE, REASONS, VIOLATION_LIST, unused_name


def _check_policy(policy_id: int) -> None:
    if not -(1 << 63) <= policy_id < 1 << 63:
        raise ValueError(f"policy id does not fit 64 bits: {policy_id}")


@dataclass(frozen=True, eq=False)
class Rule:
    """A policy and the boolean column that says an event violates it.

    The column may use any typed field, reach into `event` with `try_variant_get`, or call a UDF.
    Null counts as no violation. Mark a Python UDF `asNondeterministic()` so that it runs once per
    event even though its result is used both to filter and to list violations. With `null_failed`
    null says that the rule could not judge the event, as `python_rule` has it.
    """

    policy_id: int
    predicate: Column
    null_failed: bool = False

    def __post_init__(self):
        _check_policy(self.policy_id)


@dataclass(frozen=True)
class TokenRules:
    """Many rules that one text field contains a literal, as pairs of literal and policy id.

    They stand for as many `rule_contains` in that order, but cost one pass over the field however
    many they are, and one expression in the plan.
    """

    field: str
    tokens: Sequence[tuple[str, int]]

    def __post_init__(self):
        for _, policy_id in self.tokens:
            _check_policy(policy_id)


Rules = Sequence[Rule | TokenRules]


def rule_contains(field: str, token: str, policy_id: int) -> Rule:
    """Rule that a text field contains a literal, case-sensitively."""
    return Rule(policy_id, F.contains(F.col(field), F.lit(token)))


def python_rule(decide: Callable[..., bool | None], columns: Sequence[Column | str], policy_id: int) -> Rule:
    """Rule by a Python function of the columns' values, event by event, in Arrow batches.

    An event on which it raises is one the rule failed on; its neighbours in the batch are judged.
    """

    def judge(*values: pa.Array) -> pa.Array:
        out = []
        for row in zip(*values):
            plain = [v.as_py() for v in row]  # row by row, as an event may be long
            try:
                out.append(bool(decide(*plain)))
            except Exception:
                out.append(None)
        return pa.array(out, pa.bool_())

    judged = F.arrow_udf(judge, "boolean").asNondeterministic()
    return Rule(policy_id, judged(*columns), null_failed=True)


def apply_rules(
    events: DataFrame,
    rules: Rules,
    only_violating: bool = False,
    unless: Column | None = None,
    counts: str | Observation | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Attach `violations`, one entry per matching rule in rule order, replacing any there were.

    The column is the last, however many rules there are. With `only_violating` the events without a
    match are dropped; the result equals `only_violations(apply_rules(events, rules))` and is
    faster, because lists are made for the rest only. Rows where `unless` is true are no events:
    they match no rule and are never dropped. `counts` names an observation of `events` and
    `violating`, and of rows by `reason` where there is such a column.

    An event on which a rule raises fails the job, unless `on_error` says otherwise. With `skip` the
    rule does not match that event. With `quarantine` the event is set aside whole, since its
    judgement is not complete: it has no violations, the `reason` is `rule:` and the ids of the
    policies that failed, and `raw` is its text; `events` must have these columns, as
    `decode_outcomes` gives them. Either costs the rules their compiled code, as each is evaluated
    apart. A Python UDF that raises is beyond either; `python_rule` is not.
    """
    if on_error not in ("fail", "skip", "quarantine"):
        raise ValueError(f"on_error must be 'fail', 'skip' or 'quarantine', not {on_error!r}")
    if on_error == "quarantine" and not {"reason", "raw", "event"} <= set(events.columns):
        raise ValueError("only rows of decode_outcomes can be set aside")
    exempt = F.lit(False) if unless is None else unless
    plain = [r for r in rules if isinstance(r, Rule)]
    outcomes = [_outcome(r, on_error) for r in plain]
    if unless is not None:
        outcomes = [F.when(exempt, False).otherwise(o) for o in outcomes]
    # All outcomes are one column, so that a UDF in a rule serves filter and list with one call.
    hits = unused_name(events.columns, "hits")
    sets = [r for r in rules if isinstance(r, TokenRules)]
    found_in = [unused_name(events.columns, f"found{i}") for i in range(len(sets))]
    judged = events.select(
        *[c for c in events.columns if c.lower() != "violations"],
        F.array(*outcomes).cast("array<boolean>").alias(hits),
        *[_found(s, exempt).alias(n) for s, n in zip(sets, found_in)],
    )
    # Not `array_contains`: compiled together with many outcomes it makes a method too long for the
    # JVM to optimise.
    found = F.exists(hits, lambda hit: F.coalesce(hit, F.lit(False)))
    for name in found_in:
        found = found | (F.size(name) > 0)
    failed = F.exists(hits, lambda hit: hit.isNull()) if on_error == "quarantine" else F.lit(False)
    if counts is not None:
        judged = judged.observe(counts, *_counts(events, exempt, found, failed))
    if only_violating:
        judged = judged.where(exempt | found | failed)
    if on_error == "quarantine":
        ids = F.array(*[F.lit(r.policy_id) for r in plain]).cast("array<bigint>")
        missed = F.filter(F.arrays_zip(F.col(hits).alias("hit"), ids.alias("id")), lambda z: z["hit"].isNull())
        which = F.array_join(F.transform(missed, lambda z: z["id"].cast("string")), ",")
        judged = judged.withColumns(
            {
                "reason": F.when(failed, F.concat(F.lit(f"{FAILED_RULE}:"), which)).otherwise(F.col("reason")),
                "raw": F.when(failed, F.to_json("event").cast("binary")).otherwise(F.col("raw")),
                hits: F.when(~failed, F.col(hits)),
                **{n: F.when(~failed, F.col(n)) for n in found_in},
            }
        )
    listed = _violations(rules, F.col(hits), [F.col(n) for n in found_in])
    return judged.withColumn("violations", listed).drop(hits, *found_in)


def _outcome(rule: Rule, on_error: str) -> Column:
    """True or not; null where the rule failed, if that is to be told."""
    if on_error == "fail":
        if not rule.null_failed:
            return rule.predicate
        message = F.raise_error(F.lit(f"rule {rule.policy_id} failed on an event")).cast("boolean")
        return F.coalesce(rule.predicate, message)
    return rule.predicate if rule.null_failed else null_if_raised(F.coalesce(rule.predicate, F.lit(False)))


def _found(tokens: TokenRules, exempt: Column) -> Column:
    """Policies of the rules that match, in order."""
    return token_hits(F.when(~exempt, F.col(tokens.field)), tokens.tokens)


def _violations(rules: Rules, hits: Column, found: list[Column]) -> Column:
    """One violation per match, in rule order; null where `hits` are."""
    plain = [r for r in rules if isinstance(r, Rule)]
    if len(plain) == len(rules):
        return violation_list([r.policy_id for r in plain], hits)
    # Lists of plain rules that follow each other, and of each set of literals.
    parts, first, nth, sets = [], 0, 0, iter(found)
    for rule in [*rules, None]:
        if isinstance(rule, Rule):
            nth += 1
            continue
        if nth > first:
            ids = [r.policy_id for r in plain[first:nth]]
            parts.append(violation_list(ids, F.slice(hits, first + 1, nth - first)))
            first = nth
        if rule is not None:
            listed = F.transform(next(sets), lambda policy: F.struct(policy.alias("policyId")))
            parts.append(listed.cast(VIOLATION_LIST))
    return F.concat(*parts)


def _counts(events: DataFrame, exempt: Column, found: Column, failed: Column) -> list[Column]:
    counted = [F.count_if(~exempt).alias("events"), F.count_if(found & ~failed).alias("violating")]
    if "reason" in events.columns:
        counted += [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
        counted.append(F.count_if(failed).alias(FAILED_RULE))
    return counted


def only_violations(flagged: DataFrame) -> DataFrame:
    """Keep the events that violate at least one policy."""
    return flagged.where(F.size("violations") > 0)


#: Most rules and bytes of literals that a rule table may have, since both reach every worker.
MOST_RULES, MOST_RULE_BYTES = 100_000, 16 << 20


def rules_of(table: DataFrame, most_rules: int = MOST_RULES, most_bytes: int = MOST_RULE_BYTES) -> list:
    """The rules of a table: `policy_id`, `field`, `token`, and optionally `expression`.

    A row with `field` and `token` is a `rule_contains`; those of one field become one `TokenRules`.
    A row with an `expression` is a rule by that SQL condition over the typed fields. Rules come in
    the order of field and policy, conditions last. A table that is larger than the bounds is
    refused, which takes one aggregate over it, before any of it reaches the driver. Null policies
    and rows that say nothing are refused as well.
    """
    if "expression" not in table.columns:
        table = table.withColumn("expression", F.lit(None).cast("string"))
    asked = table.select("policy_id", "field", "token", "expression")
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("field", "token", "expression")]
    unclear = F.col("policy_id").isNull() | (
        F.col("expression").isNull() == (F.col("field").isNull() | F.col("token").isNull())
    )
    n, size, bad = asked.agg(
        F.count("*"), F.coalesce(F.sum(sizes[0] + sizes[1] + sizes[2]), F.lit(0)), F.count_if(unclear)
    ).first()
    if n > most_rules or size > most_bytes:
        raise ValueError(f"{n} rules of {size} bytes are more than {most_rules} and {most_bytes}")
    if bad:
        raise ValueError(f"{bad} rules have no policy, or not either a field and token or an expression")
    by_field: dict[str, list[tuple[str, int]]] = {}
    conditions = []
    for row in _sorted(asked.collect()):
        if row["expression"] is None:
            by_field.setdefault(row["field"], []).append((row["token"], row["policy_id"]))
        else:
            conditions.append(Rule(row["policy_id"], F.expr(row["expression"])))
    return [*[TokenRules(f, tokens) for f, tokens in by_field.items()], *conditions]


def _sorted(rows: Iterable) -> list:
    return sorted(rows, key=lambda r: (r["field"] or "", r["policy_id"], r["token"] or "", r["expression"] or ""))


def read_rules(spark: SparkSession, path: str, file_format: str = "parquet") -> list:
    """The rules of a stored table as it is now; see `rules_of`."""
    return rules_of(spark.read.format(file_format).load(path))
