"""Operators on DataFrames of envelopes and events; they serve batch and stream alike."""

from .decode import (
    decode_events,
    decode_lists,
    decode_outcomes,
    decompress_envelopes,
    events_of,
    quarantine,
    quarantine_of,
)
from .encode import encode_events, pack_events, route_events, route_promoted_lists
from .promote import promote_custom_violations
from .repeats import drop_repeats
from .rules import (
    Rule,
    TokenRules,
    apply_rules,
    only_violations,
    python_rule,
    read_rules,
    rule_contains,
    rules_of,
)

__all__ = [
    "Rule",
    "TokenRules",
    "apply_rules",
    "decode_events",
    "decode_lists",
    "decode_outcomes",
    "decompress_envelopes",
    "drop_repeats",
    "encode_events",
    "events_of",
    "only_violations",
    "pack_events",
    "promote_custom_violations",
    "python_rule",
    "quarantine",
    "quarantine_of",
    "read_rules",
    "route_events",
    "route_promoted_lists",
    "rule_contains",
    "rules_of",
]
