"""Detection and promotion from envelopes to their output, for batch and stream alike.

None of these plans shuffles: each input partition is decoded, judged and written by its own task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.decode import (
    DEFAULT_FIELDS,
    decode_events,
    decode_lists,
    decode_outcomes,
    decompress_envelopes,
    stop_at_bad,
)
from ..operators.encode import MESSAGE_BYTES, route_events, route_promoted_lists
from ..operators.promote import promote_custom_violations
from ..operators.rules import Rules, apply_rules
from ..schemas import DEFAULT_NAMES, FieldNames


def detect(
    envelopes: DataFrame,
    rules: Rules,
    codec: str = "gzip",
    fields: str = DEFAULT_FIELDS,
    on_bad: str = "skip",
    counts: str | Observation | None = None,
    on_rule_error: str = "fail",
) -> DataFrame:
    """Violating events with their violations. Without rules there are none.

    `on_rule_error` is `fail`, or `skip`: a rule does not match an event on which it raises.
    """
    events = decode_events(decompress_envelopes(envelopes, codec), fields, on_bad)
    return apply_rules(events, rules, only_violating=True, counts=counts, on_error=on_rule_error)


def promote(
    envelopes: DataFrame,
    codec: str = "gzip",
    names: FieldNames = DEFAULT_NAMES,
    on_bad: str = "skip",
) -> DataFrame:
    """All events, with their custom violations as violations."""
    events = decode_events(decompress_envelopes(envelopes, codec), on_bad=on_bad)
    return promote_custom_violations(events, names)


def route_detect(
    envelopes: DataFrame,
    rules: Rules,
    codec: str = "gzip",
    fields: str = DEFAULT_FIELDS,
    out_codec: str | None = None,
    names: FieldNames = DEFAULT_NAMES,
    form: str = "events",
    max_message_bytes: int = MESSAGE_BYTES,
    on_bad: str = "skip",
    counts: str | Observation | None = None,
    on_rule_error: str = "fail",
) -> DataFrame:
    """Messages for violating events plus quarantined input, ready for `write_violations`.

    One pass gives both outputs, so nothing is decoded twice and nothing has to be cached. With the
    form `events` each violating event is a message; with `lists` those of an envelope are one, or
    several where it would exceed `max_message_bytes` before compression; with `partitions` those
    of a task are one or several, whatever envelope they are from. A list has the coordinates and
    the key of its first event. `out_codec` is `codec` unless given. With `on_rule_error` set to
    `quarantine` an event on which a rule raises is set aside and the others go on. `counts` names an observation of what was decoded, flagged and set aside, which a
    stream reports in `lastProgress` and a batch through an `Observation`.
    """
    if form not in ("events", "lists", "partitions"):
        raise ValueError(f"form must be 'events', 'lists' or 'partitions', not {form!r}")
    outcomes = decode_outcomes(decompress_envelopes(envelopes, codec), fields)
    bad = F.col("reason").isNotNull()
    flagged = apply_rules(
        outcomes, rules, only_violating=True, unless=bad, counts=counts, on_error=on_rule_error
    )
    room = None if form == "events" else max_message_bytes
    routed = route_events(flagged, out_codec or codec, names, room, form == "partitions")
    return stop_at_bad(routed, on_bad)


def route_promote(
    envelopes: DataFrame,
    codec: str = "gzip",
    out_codec: str | None = None,
    names: FieldNames = DEFAULT_NAMES,
    max_message_bytes: int = MESSAGE_BYTES,
    on_bad: str = "skip",
    counts: str | Observation | None = None,
) -> DataFrame:
    """A message per envelope with all its events promoted, plus quarantined input.

    Lists that would exceed `max_message_bytes` before compression are split. `out_codec` and
    `counts` are as in `route_detect`.
    """
    lists = decode_lists(decompress_envelopes(envelopes, codec))
    routed = route_promoted_lists(lists, out_codec or codec, names, max_message_bytes, counts)
    return stop_at_bad(routed, on_bad)
