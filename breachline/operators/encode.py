"""Events to messages: the published form is a JSON list of events, like the incoming one."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ..functions.codecs import compress, compressor
from ..functions.events import (
    custom_violations,
    event_body,
    named_violations,
    with_violations_json,
)
from ..schemas import (
    COORDINATES,
    DEFAULT_NAMES,
    NOT_AN_OBJECT,
    QUARANTINE,
    REASONS,
    VIOLATIONS,
    FieldNames,
)

ROUTED_COLUMNS = ("output", *COORDINATES, "pos", "key", "value", "reason")

# Longest list before compression, unless one event alone is longer: below a broker's usual limit.
MESSAGE_BYTES = 900_000

# Messages of a packing task are handed back to Spark in batches of about this size.
_BATCH_BYTES = 2 << 20


def event_payloads(events: DataFrame, names: FieldNames = DEFAULT_NAMES) -> DataFrame:
    """Add `payload`, the event's JSON text with `violations` put into it."""
    found = F.col("violations")
    is_variant = isinstance(events.schema["violations"].dataType, VariantType)
    if not is_variant:
        found = named_violations(found, names)
    # `_body` is a column of its own so that the event is written once, not per use.
    written = events.withColumn("_body", event_body(F.col("event")))
    payload = with_violations_json(F.col("event"), F.col("_body"), found, names, is_variant)
    return written.withColumn("payload", payload).drop("_body")


def encode_events(
    events: DataFrame, codec: str = "none", names: FieldNames = DEFAULT_NAMES
) -> DataFrame:
    """One message per event: coordinates, `pos`, `key` and `value` (a list of that one event).

    The key is `topic/partition/offset/pos`. It repeats when a message is published again, so
    readers can drop duplicates, and it spreads evenly over the partitions of the target topic.
    """
    return event_payloads(events, names).select(
        *COORDINATES,
        "pos",
        message_key(*COORDINATES, "pos").alias("key"),
        compress(F.concat(F.lit("["), "payload", F.lit("]")), codec).alias("value"),
    )


def pack_events(
    events: DataFrame,
    events_per_message: int = 500,
    max_message_bytes: int = MESSAGE_BYTES,
    codec: str = "none",
    names: FieldNames = DEFAULT_NAMES,
) -> DataFrame:
    """Messages holding the events of one partition in lists: `key` (null) and `value`.

    Lists are cut at either bound before compression; an event longer than `max_message_bytes` goes
    alone. A partition without events gives no message, and there is no shuffle.
    """
    return pack_payloads(
        event_payloads(events, names).select("payload"),
        events_per_message,
        max_message_bytes,
        codec,
    )


def pack_payloads(
    payloads: DataFrame, events_per_message: int, max_message_bytes: int, codec: str
) -> DataFrame:
    """Pack a single column of JSON texts into messages, as `pack_events` does."""
    if events_per_message < 1 or max_message_bytes < 1:
        raise ValueError("message bounds must be positive")
    (column,) = payloads.columns
    encode = compressor(codec)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (text.as_py() for batch in batches for text in batch.column(0))
        done, size = [], 0
        for message in _joined(texts, events_per_message, max_message_bytes):
            done.append(encode(message))
            size += len(done[-1])
            if size >= _BATCH_BYTES:
                yield _messages(done)
                done, size = [], 0
        if done:
            yield _messages(done)

    binary = payloads.select(F.col(column).cast("binary"))
    return binary.mapInArrow(pack, "key binary, value binary")


def _joined(texts, count: int, room: int) -> Iterator[bytes]:
    held, size = [], 1  # brackets and commas take one byte more than there are texts
    for text in texts:
        if held and (len(held) == count or size + len(text) + 1 > room):
            yield b"[" + b",".join(held) + b"]"
            held, size = [], 1
        held.append(text)
        size += len(text) + 1
    if held:
        yield b"[" + b",".join(held) + b"]"


def _messages(values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(values), pa.binary()), pa.array(values, pa.binary())], ["key", "value"]
    )


def message_key(*columns: str) -> Column:
    """UTF-8 bytes of the named columns joined by slashes."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).cast("binary")


def route_events(
    outcomes: DataFrame,
    codec: str = "none",
    names: FieldNames = DEFAULT_NAMES,
    max_list_bytes: int | None = None,
    across: bool = False,
) -> DataFrame:
    """One output row per violating event and per quarantined row, told apart by `output`.

    Takes `decode_outcomes` with `violations` attached, so both outputs come from one pass. With
    `max_list_bytes` the violating events of an envelope share rows: lists of at most that many
    bytes, or of one longer event. A list has the position, and so the key, of its first event. If
    `across` is set lists go on from one envelope to the next, as far as the task has them; what is
    set aside keeps its place between them.
    """
    bad = F.col("reason").isNotNull()
    rows = event_payloads(outcomes, names).select(
        F.when(bad, QUARANTINE).otherwise(VIOLATIONS).alias("output"),
        *COORDINATES,
        "pos",
        F.when(~bad, F.col("payload")).alias("text"),
        "raw",
        "reason",
    )
    if max_list_bytes is None:
        text = F.concat(F.lit("["), "text", F.lit("]"))
        return _routed(rows.withColumn("text", text), codec)
    return _routed(_listed(rows, max_list_bytes, across), codec)


def _listed(rows: DataFrame, room: int, across: bool) -> DataFrame:
    """Rows whose texts are put into lists where they follow each other, in one envelope or across.

    The events of an envelope come one after the other from the explode, and those of a task one
    envelope after the other, so no shuffle is needed. Only texts become Python objects, to be
    joined; the other columns are taken from the batch row by row number. A row without a text stands
    for itself and, across envelopes, does not end the list it comes amid: it goes out before it.
    """
    if room < 1:
        raise ValueError("message bounds must be positive")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The list that is being filled: its first row, and the texts.
        head: pa.RecordBatch | None = None
        place: tuple | None = None
        texts: list[str] = []
        size = 1
        for batch in batches:
            sizes = pc.binary_length(batch.column("text").cast(pa.binary())).to_pylist()
            places = list(zip(*(batch.column(c).to_pylist() for c in COORDINATES)))
            # Rows to give, in order: what each is made of, and its text.
            given: list[tuple[int, str | None]] = []
            held = 0  # bytes of texts to give, from when on they go out amid the batch
            begun = -1  # row of this batch at which the list began; -1 if before
            for i, value in enumerate(batch.column("text")):
                if held >= _BATCH_BYTES:
                    yield from _given(batch, head, given)
                    given, held = [], 0
                held += sizes[i] or 0
                body = value.as_py()
                if body is None:
                    if not across and texts:
                        given.append((begun, _list_of(texts)))
                        texts, size, place = [], 1, None
                    given.append((i, None))
                    continue
                more = sizes[i] + 1
                if texts and (size + more > room or not (across or places[i] == place)):
                    given.append((begun, _list_of(texts)))
                    texts, size = [], 1
                if not texts:
                    begun, place = i, places[i]
                texts.append(body)
                size += more
            yield from _given(batch, head, given)
            if texts and begun >= 0:
                head = batch.slice(begun, 1)
            elif not texts:
                head = None
        if texts:
            yield from _given(head, head, [(0, _list_of(texts))])

    return rows.mapInArrow(join, rows.schema)


def _list_of(texts: list[str]) -> str:
    return "[" + ",".join(texts) + "]"


def _given(
    batch: pa.RecordBatch, head: pa.RecordBatch | None, given: list[tuple[int, str | None]]
) -> Iterator[pa.RecordBatch]:
    """Rows of the batch by number, -1 for the head, with new texts; in batches of bounded size."""
    at = 0
    while at < len(given):
        end, size = at, 0
        while end < len(given) and size < _BATCH_BYTES:
            size += len(given[end][1] or "")
            end += 1
        part = given[at:end]
        both = pa.Table.from_batches([batch] if head is None else [batch, head])
        rows = both.take([batch.num_rows if i < 0 else i for i, _ in part])
        texts = pa.array([t for _, t in part], batch.schema.field("text").type)
        rows = rows.set_column(rows.schema.get_field_index("text"), batch.schema.field("text"), texts)
        yield from rows.combine_chunks().to_batches()
        at = end


def route_promoted_lists(
    lists: DataFrame,
    codec: str = "none",
    names: FieldNames = DEFAULT_NAMES,
    max_list_bytes: int = MESSAGE_BYTES,
    counts: str | Observation | None = None,
) -> DataFrame:
    """Promote within each envelope and publish its whole list as one message.

    Takes `decode_lists`. Array functions keep the list together, so no shuffle is needed to put the
    events of an envelope back into one message. An empty list gives no message. A list longer than
    `max_list_bytes` is split; the first part has no position, the others that of their first event
    among the good ones. `counts` names an observation of `events` and of what is set aside.
    """
    if max_list_bytes < 1:
        raise ValueError("message bounds must be positive")
    written = lists.select(
        *COORDINATES, "reason", "raw", F.transform("events", _part).alias("parts")
    )
    parts = written.select(
        *COORDINATES,
        "reason",
        "raw",
        F.filter("parts", lambda p: p["body"].isNotNull()).alias("good"),
        F.filter("parts", lambda p: p["body"].isNull()).alias("stray"),
    )
    promoted = F.transform(
        "good",
        lambda p: with_violations_json(
            p["event"], p["body"], custom_violations(p["event"], names), names
        ),
    )
    if counts is not None:
        parts = parts.observe(
            counts,
            F.sum(F.coalesce(F.size("good"), F.lit(0))).alias("events"),
            F.sum(F.when(F.col("reason").isNull(), F.size("stray")).otherwise(0)).alias(NOT_AN_OBJECT),
            *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS if r != NOT_AN_OBJECT],
        )
    nothing = F.array().cast(
        "array<struct<output:string,pos:int,text:string,raw:binary,reason:string>>"
    )
    parts = parts.withColumn("promoted", promoted)
    # Brackets and commas take one byte more than there are events.
    fits = F.aggregate(
        "promoted", F.lit(1).cast("long"), lambda n, t: n + F.octet_length(t) + 1
    ) <= max_list_bytes
    whole = F.array(_row(VIOLATIONS, text=_list_text(F.col("promoted"))))
    rows = F.concat(
        F.when(F.size("promoted") == 0, nothing)
        .when(F.size("promoted") > 0, F.when(fits, whole).otherwise(_split(max_list_bytes)))
        .otherwise(nothing),
        F.when(
            F.col("reason").isNull(),
            F.transform(
                "stray",
                lambda p: _row(
                    QUARANTINE,
                    pos=p["pos"],
                    raw=F.to_json(p["event"]).cast("binary"),
                    reason=F.lit(NOT_AN_OBJECT),
                ),
            ),
        ).otherwise(F.array(_row(QUARANTINE, raw=F.col("raw"), reason=F.col("reason")))),
    )
    exploded = parts.select(*COORDINATES, rows.alias("rows")).select(
        *COORDINATES, F.inline_outer("rows")
    )
    return _routed(exploded.where(F.col("output").isNotNull()), codec)


def _list_text(texts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def _split(room: int) -> Column:
    """Rows for an over-long list `promoted`: each takes what fits, at least one event."""
    start = F.struct(
        F.lit(0).cast("long").alias("size"), F.array().cast("array<int>").alias("firsts")
    )

    def step(state: Column, at: Column) -> Column:
        more = F.octet_length(F.get("promoted", at)) + 1
        opens = (F.size(state["firsts"]) == 0) | (state["size"] + more > room)
        return F.struct(
            F.when(opens, 1 + more).otherwise(state["size"] + more).cast("long").alias("size"),
            F.when(opens, F.concat(state["firsts"], F.array(at))).otherwise(state["firsts"]).alias("firsts"),
        )

    places = F.sequence(F.lit(0), F.size("promoted") - 1)
    firsts = F.aggregate(places, start, step, lambda state: state["firsts"])
    ends = F.concat(F.slice(firsts, 2, F.size("promoted")), F.array(F.size("promoted")))
    return F.zip_with(
        firsts,
        ends,
        lambda first, end: _row(
            VIOLATIONS,
            pos=F.when(first > 0, first),
            text=_list_text(F.slice("promoted", first + 1, end - first)),
        ),
    )


def _part(event: Column, pos: Column) -> Column:
    body = event_body(event).alias("body")
    return F.struct(pos.alias("pos"), event.alias("event"), body)


def _row(
    output: str,
    pos: Column | None = None,
    text: Column | None = None,
    raw: Column | None = None,
    reason: Column | None = None,
) -> Column:
    def or_null(column, kind, name):
        return (F.lit(None) if column is None else column).cast(kind).alias(name)

    return F.struct(
        F.lit(output).alias("output"),
        or_null(pos, "int", "pos"),
        or_null(text, "string", "text"),
        or_null(raw, "binary", "raw"),
        or_null(reason, "string", "reason"),
    )


def _routed(rows: DataFrame, codec: str) -> DataFrame:
    keyed = rows.select(
        "output",
        *COORDINATES,
        "pos",
        message_key(*COORDINATES, "pos").alias("key"),
        F.coalesce(compress(F.col("text"), codec), F.col("raw")).alias("value"),
        "reason",
    )
    return keyed.select(*ROUTED_COLUMNS)
