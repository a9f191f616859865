"""Column functions: codecs and event handling."""

from .codecs import CODECS, compress, decompress
from .events import (
    custom_violations,
    event_body,
    event_list,
    named_violations,
    typed_fields,
    violation_list,
    with_violations_json,
)

__all__ = [
    "CODECS",
    "compress",
    "custom_violations",
    "decompress",
    "event_body",
    "event_list",
    "named_violations",
    "typed_fields",
    "violation_list",
    "with_violations_json",
]
