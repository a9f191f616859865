"""Envelopes to events: decompress, parse, explode, and set aside what cannot be decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.codecs import decompress
from ..functions.events import event_list, is_json, typed_fields
from ..schemas import (
    BAD_COMPRESSION,
    BAD_JSON,
    COORDINATES,
    NOT_A_LIST,
    NOT_AN_OBJECT,
    RESERVED,
)

DEFAULT_FIELDS = "requesturl string"


def decompress_envelopes(envelopes: DataFrame, codec: str = "gzip") -> DataFrame:
    """Add `json`, the text of each envelope; null where the value cannot be decompressed.

    Apply filters on topic, partition or offset before this step: they do not move below it.
    """
    return envelopes.withColumn("json", decompress(F.col("value"), codec))


def decode_lists(texts: DataFrame) -> DataFrame:
    """One row per envelope: coordinates, `events` (array<variant>), `reason` and `raw`.

    A bad envelope has null events, a reason, and its original bytes in `raw`.
    """
    parsed = texts.select(*COORDINATES, "value", "json", event_list(F.col("json")).alias("events"))
    return parsed.select(
        *COORDINATES,
        "events",
        _reason().alias("reason"),
        F.when(F.col("events").isNull(), F.col("value")).alias("raw"),
    )


def _reason() -> Column:
    # Branches are tried in order, so a good envelope is parsed once and only a bad one again.
    return (
        F.when(F.col("events").isNotNull(), F.lit(None))
        .when(F.col("json").isNull(), BAD_COMPRESSION)
        .when(~is_json(F.col("json")), BAD_JSON)
        .otherwise(NOT_A_LIST)
    )


def decode_outcomes(texts: DataFrame, fields: str = DEFAULT_FIELDS) -> DataFrame:
    """One row per event and one per thing that is not an event, in a single pass.

    Columns: coordinates, `pos`, the typed `fields`, `event`, and for bad rows `reason` and `raw`
    (the envelope's bytes, or the text of a single list element). Use this rather than
    `decode_events` plus `quarantine` where both are wanted, so the input is decoded once.
    """
    names = _field_names(fields)
    # Fields are read inside the list, once per event. Read after the explode, the cast would be
    # copied into every filter pushed down to it, twice per rule.
    lists = decode_lists(texts).withColumn(
        "events",
        F.transform(
            "events",
            lambda e: F.struct(e.alias("event"), typed_fields(e, fields).alias("typed")),
        ),
    )
    # The outer form keeps bad envelopes in the flow. It also stops Catalyst from deriving a filter
    # on the list, which would be pushed below the parse and repeat it.
    exploded = lists.select(
        *COORDINATES, "reason", "raw", F.posexplode_outer("events").alias("pos", "element")
    ).where(F.col("pos").isNotNull() | F.col("reason").isNotNull())
    stray = F.col("pos").isNotNull() & F.col("element.typed").isNull()
    return exploded.select(
        *COORDINATES,
        "pos",
        *[F.col("element.typed")[name].alias(name) for name in names],
        F.col("element.event").alias("event"),
        F.when(stray, NOT_AN_OBJECT).otherwise(F.col("reason")).alias("reason"),
        F.when(stray, F.to_json("element.event").cast("binary"))
        .otherwise(F.col("raw"))
        .alias("raw"),
    )


def decode_events(
    texts: DataFrame, fields: str = DEFAULT_FIELDS, on_bad: str = "skip"
) -> DataFrame:
    """One row per event: coordinates, `pos`, the typed `fields` and the whole `event`.

    `on_bad="skip"` leaves bad input to `quarantine`. `on_bad="fail"` stops the job at text that is
    not a list of objects; undecodable bytes are skipped either way.
    """
    return events_of(stop_at_bad(decode_outcomes(texts, fields), on_bad))


def stop_at_bad(rows: DataFrame, on_bad: str) -> DataFrame:
    """The rows, which have coordinates and `reason`; with `fail` the job stops at bad text."""
    if on_bad == "fail":
        return rows.withColumn("reason", _raise_unless_bytes(F.col("reason")))
    if on_bad != "skip":
        raise ValueError(f"on_bad must be 'skip' or 'fail', not {on_bad!r}")
    return rows


def _raise_unless_bytes(reason: Column) -> Column:
    where = F.concat_ws("/", *[F.col(c).cast("string") for c in COORDINATES])
    message = F.concat(F.lit("bad event list at "), where, F.lit(": "), reason)
    text = reason.isin(BAD_JSON, NOT_A_LIST, NOT_AN_OBJECT)
    return F.when(text, F.raise_error(message).cast("string")).otherwise(reason)


def events_of(outcomes: DataFrame) -> DataFrame:
    """The good rows of `decode_outcomes`."""
    return outcomes.where(F.col("reason").isNull()).drop("reason", "raw")


def quarantine(texts: DataFrame) -> DataFrame:
    """What could not be decoded: coordinates, `pos` (null for an envelope), `value`, `reason`."""
    return quarantine_of(decode_outcomes(texts))


def quarantine_of(outcomes: DataFrame) -> DataFrame:
    """The bad rows of `decode_outcomes`."""
    return outcomes.where(F.col("reason").isNotNull()).select(
        *COORDINATES, "pos", F.col("raw").alias("value"), "reason"
    )


def _field_names(fields: str) -> list[str]:
    names = StructType.fromDDL(fields).names if fields else []
    taken = RESERVED.intersection(name.lower() for name in names)
    if taken:
        raise ValueError(f"typed fields may not be named {', '.join(sorted(taken))}")
    return names
