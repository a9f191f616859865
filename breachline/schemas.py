"""Column layouts shared by every stage, and the JSON names an event uses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# What the Kafka source delivers; envelopes stored as files use the same columns.
ENVELOPE = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# Where an envelope came from. With `pos`, the index in its list, it identifies an event.
COORDINATES = ("topic", "partition", "offset")

# Columns that decoding adds; a typed event field may not take one of these names.
RESERVED = frozenset(COORDINATES) | {"pos", "event", "reason", "raw"}

VIOLATION_LIST = "array<struct<policyId:bigint>>"

# Values of the `reason` column.
BAD_COMPRESSION = "decompress"
BAD_JSON = "parse"
NOT_A_LIST = "not_array"
NOT_AN_OBJECT = "not_object"
# A rule that raised on an event; the ids of such rules' policies follow after a colon.
FAILED_RULE = "rule"
REASONS = (BAD_COMPRESSION, BAD_JSON, NOT_A_LIST, NOT_AN_OBJECT)

# Values of the `output` column that routes a row to its destination.
VIOLATIONS = "violations"
QUARANTINE = "quarantine"


@dataclass(frozen=True)
class FieldNames:
    """JSON names of the parts of an event that the library itself reads or writes."""

    violations: str = "violations"
    custom_violations: str = "customViolations"
    policy_id: str = "policyId"

    def __post_init__(self):
        for name in (self.violations, self.custom_violations, self.policy_id):
            if not name or any(c in "\"'\\[]`" or not c.isprintable() for c in name):
                raise ValueError(f"unusable JSON field name: {name!r}")


DEFAULT_NAMES = FieldNames()


def unused_name(columns: list[str], name: str) -> str:
    """A name for a helper column that no other column has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
