"""Envelopes from Kafka, or from files with the same columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ENVELOPE
from .positions import Positions, positions_json

# Start positions under the names of older consumers and of Spark.
_STARTS = {"smallest": "earliest", "largest": "latest", "earliest": "earliest", "latest": "latest"}


def kafka_source_options(
    brokers: str,
    topic: str,
    start: str | Positions | None = None,
    group_id: str | None = None,
    max_message_bytes: int | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    max_records_per_partition: int | None = None,
    tls: Mapping[str, str] | None = None,
    streaming: bool = True,
    end: Positions | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    `topic` names one topic, or several separated by commas. `start` is where a query without a
    checkpoint begins (`smallest`/`earliest` or `largest`/`latest`); with a checkpoint the stored
    position wins. It may also be positions, offsets by topic and partition, of just the topics
    named. Spark reads a Kafka partition in one task unless `min_partitions` or
    `max_records_per_partition` splits it by offset range, which a topic with one hot partition
    needs. `tls` holds consumer properties such as `security.protocol`. A batch may
    have an `end`; `capped_batches` gives starts and ends at a rate per partition.
    """
    names = [name.strip() for name in topic.split(",")]
    if not brokers or not all(names):
        raise ValueError("brokers and topic must not be empty")
    options = {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(names)}
    if isinstance(start, Mapping):
        if set(start) != set(names):
            raise ValueError(f"positions are for {', '.join(sorted(start))}, not for {topic}")
        options["startingOffsets"] = positions_json(start)
    elif start is not None:
        if start.lower() not in _STARTS:
            raise ValueError(f"unknown start {start!r}; expected one of {', '.join(_STARTS)}")
        options["startingOffsets"] = _STARTS[start.lower()]
        if not streaming and options["startingOffsets"] == "latest":
            raise ValueError("a batch cannot start at the latest offset")
    if end is not None:
        if streaming or set(end) != set(names):
            raise ValueError("only a batch ends, and at positions of just the topics named")
        options["endingOffsets"] = positions_json(end)
    if group_id:
        options["kafka.group.id"] = group_id
    if max_message_bytes is not None and max_message_bytes > 0:
        options["kafka.max.partition.fetch.bytes"] = str(max_message_bytes)
    if streaming and max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_records_per_partition is not None:
        options["maxRecordsPerPartition"] = str(max_records_per_partition)
    for name, value in (tls or {}).items():
        options[name if name.startswith("kafka.") else f"kafka.{name}"] = value
    return options


def max_offsets_per_trigger(per_partition: int, seconds: float, partitions: int) -> int:
    """Limit per trigger that a rate per second and Kafka partition comes to over all partitions.

    Spark shares the limit by backlog, so a partition that lags may take more than its rate.
    """
    if per_partition < 1 or seconds <= 0 or partitions < 1:
        raise ValueError("rate, interval and partition count must be positive")
    return max(1, int(per_partition * seconds * partitions))


def read_envelopes(
    spark: SparkSession,
    kafka: Mapping[str, str] | None = None,
    path: str | None = None,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Envelopes as a DataFrame, batch or streaming.

    Give either `kafka`, the options from `kafka_source_options`, or the `path` of stored envelopes.
    """
    if (kafka is None) == (path is None):
        raise ValueError("give either kafka options or a path")
    reader = spark.readStream if streaming else spark.read
    if kafka is not None:
        return reader.format("kafka").options(**kafka).load().select(*ENVELOPE.names)
    if streaming and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(file_format).schema(ENVELOPE).load(path)
