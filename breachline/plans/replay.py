"""Tables as envelopes: packing any table's rows into compressed messages, to run the jobs on it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import pack_payloads
from ..schemas import ENVELOPE

TOPIC = "events-in"


def event_json(*columns: Column | str) -> Column:
    """JSON text of an event made of the given columns; nulls are written, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def pack_table(rows: DataFrame, codec: str, events_per_message: int = 16) -> DataFrame:
    """Envelopes holding the rows as events. Rows are packed where they are, without a shuffle."""
    packed = pack_payloads(
        rows.select(event_json(*rows.columns)), events_per_message, 900_000, codec
    )
    return as_envelopes(packed, offset=F.monotonically_increasing_id())


def as_envelopes(messages: DataFrame, offset: Column) -> DataFrame:
    """Give messages the columns of the Kafka source."""
    filled = {
        "key": F.lit(None),
        "value": F.col("value"),
        "topic": F.lit(TOPIC),
        "partition": F.spark_partition_id(),
        "offset": offset,
        "timestamp": F.lit(None),
        "timestampType": F.lit(0),
    }
    return messages.select(*[filled[f.name].cast(f.dataType).alias(f.name) for f in ENVELOPE])


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the one the cluster shares between its executors.

    The folder is deleted when the driver's JVM ends, for what a query returns may still read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
