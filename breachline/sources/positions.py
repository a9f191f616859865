"""Positions in topics: where to go on, how far one batch may go, and keeping both.

A position is the offset that a partition is read from next. Positions are mappings of topics to
mappings of partitions to offsets, as small as the number of partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Positions = Mapping[str, Mapping[int, int]]

_STORED = "topic string, partition int, next_offset bigint"


def positions_json(positions: Positions) -> str:
    """Positions in the form that Spark's Kafka source takes and reports."""
    for topic, partitions in positions.items():
        for partition, offset in partitions.items():
            # -1 and -2 are Kafka's latest and earliest.
            if partition < 0 or offset < -2:
                raise ValueError(f"no position: {topic}/{partition} at {offset}")
    return json.dumps({t: {str(p): o for p, o in sorted(ps.items())} for t, ps in sorted(positions.items())})


def positions_of(text: str | None) -> dict[str, dict[int, int]]:
    """Positions that a stream reports, as `endOffset` of a source in `lastProgress`."""
    found = json.loads(text) if text else {}
    return {t: {int(p): o for p, o in ps.items()} for t, ps in found.items()}


def next_positions(envelopes: DataFrame) -> DataFrame:
    """Position after the last envelope of every partition: `topic`, `partition`, `next_offset`."""
    return envelopes.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def first_positions(envelopes: DataFrame) -> DataFrame:
    """Position of the first envelope of every partition, in the columns of `next_positions`."""
    return envelopes.groupBy("topic", "partition").agg(F.min("offset").alias("next_offset"))


def collect_positions(rows: DataFrame) -> dict[str, dict[int, int]]:
    """Positions of a table; it has one row per partition of a topic, thousands at most."""
    found: dict[str, dict[int, int]] = {}
    for topic, partition, offset in rows.select("topic", "partition", "next_offset").collect():
        found.setdefault(topic, {})[partition] = offset
    return found


def _at(positions: Positions) -> Column:
    """The position of a row's partition; null if it has none."""
    pairs = [
        F.lit(x) for t, ps in positions.items() for p, o in ps.items() for x in (f"{t}/{p}", o)
    ]
    if not pairs:
        return F.lit(None).cast("bigint")
    key = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    return F.try_element_at(F.create_map(*pairs), key).cast("bigint")


def between(envelopes: DataFrame, start: Positions, end: Positions | None = None) -> DataFrame:
    """Envelopes from `start` on and before `end`, for sources that keep offsets but cannot seek.

    A partition that `start` does not know is read from its beginning; one that `end` does not know
    is left for later. Where all are known, the ranges of offsets go down to the scan, so that files
    skip what lies between the ranges of partitions that are apart.
    """
    known = [o for ps in start.values() for o in ps.values()]
    at = _at(start)
    rows = envelopes.where(at.isNull() | (F.col("offset") >= at))
    if end is not None:
        last = [o for ps in end.values() for o in ps.values()]
        rows = rows.where(F.col("offset") < max(last, default=0)).where(F.col("offset") < _at(end))
        if known and {(t, p) for t, ps in end.items() for p in ps} <= {
            (t, p) for t, ps in start.items() for p in ps
        }:
            rows = rows.where(F.col("offset") >= min(known)).where(_in_ranges(start, end))
    return rows


# Most ranges of offsets that a scan is given; the nearest are joined beyond that.
_MOST_RANGES = 256


def _ranges(start: Positions, end: Positions) -> list[tuple[int, int]]:
    """Offsets from, to and without, that partitions have to read, in order; those that meet are one."""
    asked = sorted((start[t][p], o) for t, ps in end.items() for p, o in ps.items() if start[t][p] < o)
    ranges: list[tuple[int, int]] = []
    for first, last in asked:
        if ranges and first <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(last, ranges[-1][1]))
        else:
            ranges.append((first, last))
    gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i - 1][1] - ranges[i][0])
    cuts = [0, *sorted(gaps[: _MOST_RANGES - 1]), len(ranges)]
    return [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(cuts, cuts[1:]) if a < b]


def _in_ranges(start: Positions, end: Positions) -> Column:
    """Whether an offset is in a range of any partition; what else a partition asks is for the caller."""
    tests = [(F.col("offset") >= a) & (F.col("offset") < b) for a, b in _ranges(start, end)]
    while len(tests) > 1:  # in pairs, so that the expression is not as deep as there are ranges
        tests = [x | y for x, y in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2 :]
    return tests[0] if tests else F.lit(False)


def capped_end(start: Positions, latest: Positions, most: int) -> dict[str, dict[int, int]]:
    """End of a batch that takes at most `most` envelopes of any partition.

    Unlike a total that is shared by backlog, no partition exceeds its cap, and every one that has
    envelopes is read. A partition that `start` does not know begins at 0; one whose start lies
    beyond its latest offset, as after a topic was made anew, is refused.
    """
    if most < 1:
        raise ValueError("a batch must take something")
    end: dict[str, dict[int, int]] = {}
    for topic, partitions in latest.items():
        for partition, last in partitions.items():
            first = start.get(topic, {}).get(partition, 0)
            if first > last:
                raise ValueError(f"{topic}/{partition} starts at {first}, beyond its end at {last}")
            end.setdefault(topic, {})[partition] = min(last, first + most)
    return end


def capped_batches(
    start: Positions, latest: Positions, per_second: float, seconds: float
) -> Iterator[tuple[dict[str, dict[int, int]], dict[str, dict[int, int]]]]:
    """Start and end of one batch after the other until `latest`, at a rate per partition."""
    most = int(per_second * seconds)
    now = {t: {p: start.get(t, {}).get(p, 0) for p in ps} for t, ps in latest.items()}
    goal = {t: dict(ps) for t, ps in latest.items()}
    while now != goal:
        end = capped_end(now, goal, most)
        yield now, end
        now = end


class PositionStore:
    """Positions kept in a folder, apart from any checkpoint, so that another job can go on from them.

    Every step is a small table of all positions known, in a folder of its own; the last whole one
    counts, and the one before it is kept. Positions never go back, so keeping those of a batch that
    is done again changes nothing. One job at a time may write.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._files = self._hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _steps(self) -> list[int]:
        if not self._files.exists(self._hadoop(self.path)):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._hadoop(self.path))]
        steps = [int(n.removeprefix("step=")) for n in names if n.startswith("step=")]
        return sorted(n for n in steps if self._files.exists(self._hadoop(f"{self.path}/step={n}/_SUCCESS")))

    def load(self) -> dict[str, dict[int, int]]:
        """The positions to go on from; none at the beginning."""
        steps = self._steps()
        if not steps:
            return {}
        return collect_positions(self.spark.read.schema(_STORED).parquet(f"{self.path}/step={steps[-1]}"))

    def save(self, reached: DataFrame | Positions) -> None:
        """Keep the positions after a batch, which must have been written."""
        now = collect_positions(reached) if isinstance(reached, DataFrame) else reached
        merged, steps = self.load(), self._steps()
        for topic, partitions in now.items():
            for partition, offset in partitions.items():
                known = merged.setdefault(topic, {}).get(partition, offset)
                merged[topic][partition] = max(offset, known)
        rows = [(t, p, o) for t, ps in merged.items() for p, o in ps.items()]
        step = steps[-1] + 1 if steps else 0
        table = self.spark.createDataFrame(rows, _STORED).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.path}/step={step}")
        for old in steps[:-1]:
            self._files.delete(self._hadoop(f"{self.path}/step={old}"), True)
