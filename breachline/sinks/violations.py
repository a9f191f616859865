"""Writing routed rows: to topics or to files, from a batch or from a stream."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..schemas import QUARANTINE, VIOLATIONS


@dataclass(frozen=True)
class KafkaSink:
    """Topics for the two outputs. Without a quarantine topic, bad input is left out of the main
    sink; as a quarantine sink it goes to the one topic there is.

    Delivery is at least once; message keys let readers drop repeats.
    """

    brokers: str
    violation_topic: str
    quarantine_topic: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def rows(self, routed: DataFrame) -> DataFrame:
        """Columns of Spark's Kafka sink; each row names its topic, so one write serves both."""
        if self.quarantine_topic is None:
            routed = routed.where(F.col("output") == VIOLATIONS)
        target = F.when(F.col("output") == QUARANTINE, self.quarantine_topic)
        reason = F.struct(
            F.lit("reason").alias("key"), F.col("reason").cast("binary").alias("value")
        )
        return routed.select(
            target.otherwise(self.violation_topic).alias("topic"),
            "key",
            "value",
            F.when(F.col("reason").isNotNull(), F.array(reason)).alias("headers"),
        )

    def for_quarantine(self) -> KafkaSink:
        """The sink when it is handed bad input only."""
        return replace(self, quarantine_topic=self.quarantine_topic or self.violation_topic)

    def settings(self) -> dict[str, str]:
        """Options of Spark's Kafka sink."""
        return {"kafka.bootstrap.servers": self.brokers, **self.options}


@dataclass(frozen=True)
class FileSink:
    """A table of routed rows below `path`, one folder per output.

    A stream writes each batch to folders of its own, `query=<id>/batch=<n>/output=<o>`, so queries
    and outputs may share a path. A batch that is done again replaces its own files only.
    """

    path: str
    file_format: str = "parquet"

    def for_quarantine(self) -> FileSink:
        """The sink when it is handed bad input only; its folders are apart already."""
        return self


Sink = KafkaSink | FileSink


def write_violations(
    routed: DataFrame, sink: Sink, mode: str = "append", rebalance: bool = False
) -> DataStreamWriter | None:
    """Write a batch, or return the writer of a stream for the caller to start.

    `rebalance` evens out the files: where few events violate a rule, every task would otherwise
    leave a tiny file. It shuffles the output rows, not the input. Leave it off where most events
    are written. Kafka has no files and only appends, and a stream replaces nothing but a batch that
    is done again, so `mode` and `rebalance` are refused where they mean nothing.
    """
    if isinstance(sink, KafkaSink) and (mode != "append" or rebalance):
        raise ValueError("a Kafka sink only appends, and has no files to rebalance")
    if routed.isStreaming and mode != "append":
        raise ValueError("a stream only appends")
    if isinstance(sink, KafkaSink):
        rows = sink.rows(routed)
        if rows.isStreaming:
            return rows.writeStream.format("kafka").options(**sink.settings())
        rows.write.format("kafka").options(**sink.settings()).save()
        return None
    if routed.isStreaming:
        refuse_logged_folder(routed.sparkSession, sink)
        return routed.writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, sink, batch_id, rebalance)
        )
    if rebalance:
        routed = routed.hint("rebalance")
    routed.write.format(sink.file_format).mode(mode).partitionBy("output").save(sink.path)
    return None


def write_batch(
    rows: DataFrame, sink: Sink, batch_id: int, rebalance: bool = False, output: str | None = None
) -> None:
    """Write one batch of a stream, inside its batch function; of the rows of one `output`, if named.

    What an earlier attempt at the batch left is deleted first, so outputs for which there are no rows
    any more, as rules have changed meanwhile, keep none. Another output's folder is left alone.
    """
    if isinstance(sink, KafkaSink):
        write_violations(rows, sink)
        return
    spark = rows.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    folder = f"{sink.path}/query={query}/batch={batch_id}"
    earlier = spark._jvm.org.apache.hadoop.fs.Path(folder if output is None else f"{folder}/output={output}")
    earlier.getFileSystem(spark._jsc.hadoopConfiguration()).delete(earlier, True)
    if rebalance:
        rows = rows.hint("rebalance")
    rows.write.format(sink.file_format).partitionBy("output").mode("append").save(folder)


def refuse_logged_folder(spark: SparkSession, sink: Sink) -> None:
    """Stop where readers would not see new files: a log of Spark's own file sink governs the folder."""
    if isinstance(sink, FileSink):
        log = spark._jvm.org.apache.hadoop.fs.Path(f"{sink.path}/_spark_metadata")
        if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
            raise ValueError(f"{sink.path} holds the log of another kind of stream; choose a new path")
