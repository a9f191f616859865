"""Running a routed stream: interval, checkpoint, one sink or two, and a hook per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import QUARANTINE, VIOLATIONS
from ..sinks.violations import Sink, refuse_logged_folder, write_batch, write_violations
from ..sources.positions import PositionStore, next_positions
from .stop import unless_asked


def run_detection(
    routed: DataFrame,
    sink: Sink,
    checkpoint: str,
    interval: str | None = None,
    available_now: bool = False,
    quarantine_sink: Sink | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    name: str | None = None,
    rebalance: bool = False,
    route: Callable[[DataFrame], DataFrame] | None = None,
    positions: str | None = None,
    stop_marker: str | None = None,
) -> StreamingQuery:
    """Start the job on a routed stream and return its query; call `awaitTermination()` to wait.

    `checkpoint` is a folder all executors can reach. It holds the position in the source, which
    advances only after a batch is written; a failed batch stops the query and is done again when
    it is started anew. `interval` carries its unit, such as "10 seconds". `available_now` works off
    what is there and stops.

    One sink takes both outputs in a single write. With `quarantine_sink` or the hook `on_batch`
    each batch has several readers, so its output rows are kept until all have run. Files lie alike
    in either form, so a sink or hook may be added on restart. `rebalance` evens out the files of
    each batch.

    With `route`, `routed` is the stream of envelopes, and each batch is routed by what the function
    makes of it when its turn comes. So rules that it reads, as with `read_rules`, hold from the next
    batch on when they change, and no restart is needed. With `positions` as well, a folder, the
    position after each batch is kept there when it is written; see `PositionStore`.

    `stop_marker` names a file. While it exists no batch begins: the one in progress is written and
    committed, and the query ends. `await_stop` waits for that.
    """
    if positions is not None and route is None:
        raise ValueError("positions are read from envelopes, so they need a route")
    if interval is not None and available_now:
        raise ValueError("give either an interval or available_now")
    plain = quarantine_sink is None and on_batch is None and route is None
    if plain and stop_marker is None:
        writer = write_violations(routed, sink, rebalance=rebalance)
    else:
        for target in filter(None, (sink, quarantine_sink)):
            refuse_logged_folder(routed.sparkSession, target)
        write = _batch_writer(sink, quarantine_sink, on_batch, rebalance, route, positions)
        if stop_marker is not None:
            write = unless_asked(write, stop_marker)
        writer = routed.writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def _batch_writer(sink, quarantine_sink, on_batch, rebalance, route, positions):
    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch if route is None else route(batch), batch_id)
        if positions is not None:
            PositionStore(batch.sparkSession, positions).save(next_positions(batch))

    def publish(batch: DataFrame, batch_id: int) -> None:
        if quarantine_sink is None and on_batch is None:
            write_batch(batch, sink, batch_id, rebalance)
            return
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if quarantine_sink is None:
                write_batch(kept, sink, batch_id, rebalance)
            else:
                good, bad = (kept.where(F.col("output") == o) for o in (VIOLATIONS, QUARANTINE))
                write_batch(good, sink, batch_id, rebalance, VIOLATIONS)
                write_batch(bad, quarantine_sink.for_quarantine(), batch_id, rebalance, QUARANTINE)
            if on_batch is not None:
                on_batch(kept, batch_id)
        finally:
            kept.unpersist()

    return write
