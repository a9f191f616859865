"""Where envelopes come from."""

from .envelopes import kafka_source_options, max_offsets_per_trigger, read_envelopes
from .positions import (
    PositionStore,
    between,
    capped_batches,
    capped_end,
    collect_positions,
    first_positions,
    next_positions,
    positions_of,
)

__all__ = [
    "PositionStore",
    "between",
    "capped_batches",
    "capped_end",
    "collect_positions",
    "first_positions",
    "kafka_source_options",
    "max_offsets_per_trigger",
    "next_positions",
    "positions_of",
    "read_envelopes",
]
