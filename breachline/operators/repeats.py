"""Dropping messages that were published more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_repeats(published: DataFrame, within: str = "1 hour", time: str = "timestamp") -> DataFrame:
    """Published messages, each key once; the columns stay as they are.

    A batch that is done again publishes its messages again, under the same keys
    (`topic/partition/offset/pos`). A stream remembers a key until the time column, which a Kafka
    source fills, has moved on by `within`; so the state is bounded by the messages of that time,
    and a repeat must come within it. A batch compares all it reads. Repeats may come in any order
    and through any partition. Messages without a key are no one's repeat and all stay.
    """
    keyed, bare = published.where(F.col("key").isNotNull()), published.where(F.col("key").isNull())
    if not published.isStreaming:
        return keyed.dropDuplicates(["key"]).unionByName(bare)
    once = keyed.withWatermark(time, within).dropDuplicatesWithinWatermark(["key"])
    return once.unionByName(bare.withWatermark(time, within))
