"""Policy violation detection over compressed batches of JSON events, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from .operators import (
    Rule,
    TokenRules,
    apply_rules,
    decode_events,
    decode_lists,
    decode_outcomes,
    decompress_envelopes,
    drop_repeats,
    encode_events,
    events_of,
    only_violations,
    pack_events,
    promote_custom_violations,
    python_rule,
    quarantine,
    quarantine_of,
    read_rules,
    rule_contains,
    rules_of,
)
from .plans import detect, promote, route_detect, route_promote
from .schemas import ENVELOPE, FieldNames
from .sinks import FileSink, KafkaSink, write_violations
from .sources import (
    PositionStore,
    between,
    capped_batches,
    collect_positions,
    first_positions,
    kafka_source_options,
    max_offsets_per_trigger,
    next_positions,
    positions_of,
    read_envelopes,
)
from .streaming import ask_to_stop, await_stop, run_detection

# The functions that run in Python workers travel with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "ENVELOPE",
    "FieldNames",
    "FileSink",
    "KafkaSink",
    "PositionStore",
    "Rule",
    "TokenRules",
    "apply_rules",
    "ask_to_stop",
    "await_stop",
    "between",
    "capped_batches",
    "collect_positions",
    "decode_events",
    "decode_lists",
    "decode_outcomes",
    "decompress_envelopes",
    "detect",
    "drop_repeats",
    "encode_events",
    "events_of",
    "first_positions",
    "kafka_source_options",
    "max_offsets_per_trigger",
    "next_positions",
    "only_violations",
    "pack_events",
    "positions_of",
    "promote",
    "promote_custom_violations",
    "python_rule",
    "quarantine",
    "quarantine_of",
    "read_envelopes",
    "read_rules",
    "route_detect",
    "route_promote",
    "rule_contains",
    "rules_of",
    "run_detection",
    "write_violations",
]
