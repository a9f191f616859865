"""Helpers of the operators: staged tables in the shared folder, and connected components."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: the ASCII white space `[\x20\x09-\x0D]`, and nothing else.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from `spark.checkpoint.dir`.

    Only a local session that sets none, as in tests, gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def kept_by_worker(key: str, make: Callable[[], Any]) -> Any:
    """What a Python worker makes once and keeps for later tasks.

    Functions travel with each job by value, so what their own modules hold does not last.
    """
    box = sys.modules.setdefault("_breachline_kept", types.ModuleType("_breachline_kept"))
    if key not in box.__dict__:
        box.__dict__[key] = make()
    return box.__dict__[key]


#: Folders of the staged tables that are still there.
_staged: list[str] = []


def stage(frame: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    It cuts lineage: a lost executor costs its running tasks, not the work before the table. The
    folder is deleted when the driver's JVM ends, or before by `release` or `release_staged`.

    For rows of megabytes, `group_bytes` bounds the row groups: none has more beside its last row.
    Parquet else looks at sizes every 100 rows only, so all rows of a task become one group, which
    is written and read as a whole, and is never split among tasks.
    """
    spark = frame.sparkSession
    path = os.path.join(shared_folder(spark), f"stage-{uuid.uuid4().hex}")
    writer = frame.write
    if group_bytes is not None:
        writer = writer.option("parquet.block.size", group_bytes)
        for part in ("block", "page"):
            writer = writer.option(f"parquet.{part}.size.row.check.min", 1)
    writer.parquet(path)
    _staged.append(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(frame.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    _staged.remove(path)


def release(frame: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    files = frame.inputFiles()
    for path in [p for p in _staged if any(os.path.basename(p) in f for f in files)]:
        _delete(frame.sparkSession, path)


def staged() -> list[str]:
    """Folders of the staged tables that are still there."""
    return list(_staged)


def release_staged(spark: SparkSession, folders: list[str], reading: DataFrame) -> None:
    """Delete staged tables, but for those that a frame still reads."""
    files = reading.inputFiles()
    for path in folders:
        if path in _staged and not any(os.path.basename(path) in f for f in files):
            _delete(spark, path)


def hide(
    frame: DataFrame, plain: tuple[str, ...] = (), without: tuple[str, ...] = ()
) -> tuple[list[Column], dict[str, Column]]:
    """Columns to carry through an operator whatever their names: to select, and to get back.

    All but the `plain` ones, which the operator reads, go under names of this module's own, so that
    none clashes with a helper column. Those in `without` are dropped.
    """
    carried, restored = [], {}
    for i, name in enumerate(frame.columns):
        if name in plain:
            carried.append(F.col(name))
            restored[name] = F.col(name)
        elif name not in without:
            quoted = name.replace("`", "``")
            carried.append(F.col(f"`{quoted}`").alias(f"_kept_{i}"))
            restored[name] = F.col(f"_kept_{i}").alias(name)
    return carried, restored


def word_count(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(links: DataFrame) -> DataFrame:
    """Connected components of the links `a`, `b` (bigint): `node` and `root`, the smallest node.

    Alternates two steps until every component is a star around its smallest node: each node hands
    the smallest node it knows first to its larger neighbours, then to its smaller ones. A round
    takes minima, which are aggregated before they are shuffled, and joins that Spark can split
    where one node has most of the links; nothing is gathered per component. Nodes that occur in
    no link, or only in a link to themselves, are left out.
    """

    def canonical(frame: DataFrame) -> DataFrame:
        pair = frame.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        return pair.where("hi <> lo").distinct()

    def mark(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        return tuple(row)

    now = stage(canonical(links))
    seen = mark(now)
    while seen[0]:
        ends = now.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(
            now.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
        least = ends.groupBy("node").agg(F.min("other").alias("m"))
        least = least.select(F.col("node").alias("lo"), F.least("node", "m").alias("m"))
        large = now.join(least, "lo").select(F.col("hi").alias("a"), F.col("m").alias("b"))
        large = canonical(large)
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("lo").alias("a"), F.col("m").alias("b"))
        new = stage(canonical(small.union(low.select("hi", "m"))))
        was, seen = seen, mark(new)
        old, now = now, new
        release(old)
        if seen == was:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
