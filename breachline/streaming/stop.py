"""Stopping a stream between two batches."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

_ASKED = "stopped between batches as asked by"


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def ask_to_stop(spark: SparkSession, marker: str) -> None:
    """Leave the marker that a stream with `stop_marker` looks for."""
    path, files = _path(spark, marker)
    files.create(path, True).close()


def unless_asked(
    write: Callable[[DataFrame, int], None], marker: str
) -> Callable[[DataFrame, int], None]:
    """The batch function, which begins no batch while the marker exists.

    A batch that has begun is written and committed; the next one ends the query before it reads or
    writes anything, so when the query is started anew nothing is lost and nothing is sent twice.
    """

    def guarded(batch: DataFrame, batch_id: int) -> None:
        path, files = _path(batch.sparkSession, marker)
        if files.exists(path):
            raise InterruptedError(f"{_ASKED} {marker}")
        write(batch, batch_id)

    return guarded


def await_stop(query: StreamingQuery, marker: str | None = None, poll: float = 0.2) -> bool:
    """Wait until a query ends; whether it ended by its marker. Other failures are raised.

    A query that waits for data begins no batch, so it is stopped here when the marker is there and
    no trigger is active, which cancels nothing.
    """
    spark = SparkSession.active()
    while query.isActive:
        if marker is not None:
            path, files = _path(spark, marker)
            status = query.status
            if files.exists(path) and not status["isTriggerActive"] and not status["isDataAvailable"]:
                query.stop()
                return True
        time.sleep(poll)
    try:
        query.awaitTermination()
    except StreamingQueryException as failure:
        if _ASKED not in str(failure):
            raise
        return True
    return False

