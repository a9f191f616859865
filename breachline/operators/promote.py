"""Promotion: the custom violations an event carries become its violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.events import custom_violations
from ..schemas import DEFAULT_NAMES, FieldNames


def promote_custom_violations(events: DataFrame, names: FieldNames = DEFAULT_NAMES) -> DataFrame:
    """Set `violations` to the event's custom violations, whole, or null. No event is dropped."""
    return events.withColumn("violations", custom_violations(F.col("event"), names))
