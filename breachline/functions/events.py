"""Events as Spark `variant` values: reading, testing and rewriting them inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DEFAULT_NAMES, VIOLATION_LIST, FieldNames

# Spark's JSON reader is lenient by default, and it rejects very long strings and numbers. These
# settings keep it to standard JSON, of any length.
_ANY_LENGTH = str((1 << 31) - 1)
_STANDARD = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxStringLen": _ANY_LENGTH,
    "maxNumLen": _ANY_LENGTH,
}


def event_list(json: Column) -> Column:
    """`array<variant>` of a JSON list; null for anything that is not a well-formed list.

    Each element is its own variant, so a variant's limit of 128 MiB holds per event, not per list.
    """
    return F.from_json(json, "array<variant>", _STANDARD)


def is_json(text: Column) -> Column:
    """Whether a text is JSON of any kind, by the same reader."""
    return F.from_json(text, "variant", _STANDARD).isNotNull()


def typed_fields(event: Column, fields: str) -> Column:
    """Struct of the named event fields; null exactly when the event is not a JSON object.

    A field that is missing or does not convert is null. One cast both reads the fields and tests
    for an object.
    """
    return event.try_cast(f"struct<{fields}>")


def custom_violations(event: Column, names: FieldNames = DEFAULT_NAMES) -> Column:
    """The violations an event already carries, kept whole; null when there are none."""
    return F.try_variant_get(event, f"$['{names.custom_violations}']", "variant")


def violation_list(policy_ids: list[int], hits: Column) -> Column:
    """One violation per policy whose entry in `hits` (array<boolean>) is true, in the given order."""
    if not policy_ids:
        return F.array().cast(VIOLATION_LIST)
    ids = F.array(*[F.lit(i).cast("bigint") for i in policy_ids])
    found = F.zip_with(hits, ids, lambda hit, i: F.when(hit, F.struct(i.alias("policyId"))))
    return F.array_compact(found).cast(VIOLATION_LIST)


def named_violations(violations: Column, names: FieldNames = DEFAULT_NAMES) -> Column:
    """A violation list with the policy id under its configured name."""
    return violations.cast(f"array<struct<`{names.policy_id}`:bigint>>")


def event_body(event: Column) -> Column:
    """JSON text of an event; null when it is not an object.

    Written as a map, because the writer for whole variants takes twice the time.
    """
    return F.to_json(_members(event))


def _members(event: Column) -> Column:
    return event.try_cast("map<string,variant>")


def with_violations_json(
    event: Column,
    body: Column,
    violations: Column,
    names: FieldNames = DEFAULT_NAMES,
    is_variant: bool = True,
) -> Column:
    """JSON text of an event whose violations are replaced by the given list, or by null.

    `body` must be `event_body(event)`. Its names are written without needless escapes, so a body that
    does not contain the quoted name has no such key, and the new entry is simply put in front. Only
    an event that has the key already is taken apart to drop it.
    """
    key = f'"{names.violations}"'
    text = F.coalesce(F.to_json(violations), F.lit("null"))
    separator = F.when(body == "{}", F.lit("")).otherwise(F.lit(","))
    in_front = F.concat(F.lit("{" + key + ":"), text, separator, F.substr(body, F.lit(2)))
    kept = F.map_filter(_members(event), lambda k, _: k != names.violations)
    value = violations if is_variant else F.to_variant_object(violations)
    entry = F.create_map(F.lit(names.violations), F.coalesce(value, F.parse_json(F.lit("null"))))
    replaced = F.to_json(F.map_concat(kept, entry))
    return F.when(F.contains(body, F.lit(key)), replaced).otherwise(in_front)
