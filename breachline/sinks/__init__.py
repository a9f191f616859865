"""Where violations and quarantined input go."""

from .violations import FileSink, KafkaSink, write_violations

__all__ = ["FileSink", "KafkaSink", "write_violations"]
