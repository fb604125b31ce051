"""Windows of a stream, put together from its closed panes.

A pane's rows are final when the watermark has passed it, so Spark's state holds open panes
alone. A window is closed with its last pane: each batch makes the windows that end between
its watermark and that of the batch before, from the panes that it closed and those that
earlier batches have closed and that still belong to an open window. Finished windows, of
which a pane makes up to length / slide, are neither held as state nor shuffled.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitlake.sources import tables
from transitlake.streaming import sink

# State of a backlog is as large as the backlog: it lies on disk, and what all stores of an
# executor hold in memory has one bound.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # costs a look-up per row, for a figure in the progress report
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# Window rows that a task makes and writes at most, nearly; a file of some 10 MB.
WINDOWS_PER_TASK = 500_000


@dataclass(frozen=True)
class PaneStream:
    """Panes of a stream and what makes windows of those that are closed."""

    panes: DataFrame
    length: int
    slide: int
    finish: Callable[[DataFrame], DataFrame]


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state on disk; what the session sets itself holds."""
    own = {k: v for k, v in STATE_SETTINGS.items() if k not in spark.conf.getAll}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in own:
            spark.conf.unset(key)


def stored_form(panes: DataFrame) -> DataFrame:
    """Panes with their start in seconds, as batches keep them."""
    start = F.unix_seconds("_pane.start").alias("_start")
    return panes.select(start, *[c for c in panes.columns if c != "_pane"])


def windows_of_panes(
    panes: DataFrame, length: int, slide: int, after: int, upto: int, tasks: int
) -> DataFrame:
    """The windows of closed panes that end later than ``after`` and not later than ``upto``.

    ``panes`` are in their stored form, one row per vehicle, trip and pane; times are whole
    seconds. Rows are placed by blocks of time, about thirty windows long, and within a
    block by vehicle and trip: a task writes few days, and a busy hour goes to many tasks.
    A pane makes the windows of which it is the first one, so each is made once.
    """
    block = slide * math.ceil(30 * length / slide)
    aligned = lambda x: f"({x} - pmod({x}, {slide}))"
    block_of = lambda x: f"({x} - pmod({x}, {block}))"
    after, upto = after - length, upto - length
    bounded = panes.withColumns(
        {
            # starts of the wanted windows that hold the pane
            "_from": F.expr(
                f"greatest({aligned(f'(_start - {length}L)')}, {after - after % slide}L) + {slide}"
            ),
            "_to": F.expr(f"least({aligned('_start')}, {upto - upto % slide}L)"),
        }
    ).where("_from <= _to")
    placed = bounded.select(
        "*",
        F.expr(
            f"explode(sequence({block_of('_from')}, {block_of('greatest(_from, _to)')}, {block}L))"
        ).alias("_block"),
        F.xxhash64("id", "trip_id").alias("_spread"),
    ).repartitionByRange(tasks, "_block", "_spread")
    trip = Window.partitionBy("_block", "_spread", "id", "trip_id").orderBy("_start")
    first = placed.select(
        "*",
        F.lag("_start").over(trip).alias("_before"),
        F.collect_list(F.struct("_start", "current_status", "route_id", "stop_id", "_last"))
        .over(trip.rangeBetween(0, length - 1))
        .alias("_panes"),
    ).withColumns(
        {
            "_from": F.expr(f"greatest(_from, _block, {aligned('_before')} + {slide})"),
            "_to": F.expr(f"least(_to, _block + {block - slide})"),
        }
    )
    windows = first.where("_from <= _to").select(
        "*", F.expr(f"explode(sequence(_from, greatest(_from, _to), {slide}L))").alias("_w")
    )
    end = f"_w + {length}"
    held = windows.withColumn(
        "_panes",
        F.expr(
            f"if(element_at(_panes, -1)._start < {end}, _panes, "
            f"filter(_panes, x -> x._start < {end}))"
        ),
    )
    highest = lambda c: F.expr(f"array_max(_panes.{c})").alias(c)
    last = "element_at(_panes, -1)._last"
    return held.select(
        "id",
        "trip_id",
        F.expr(
            f"named_struct('start', timestamp_seconds(_w), 'end', timestamp_seconds({end}))"
        ).alias("window"),
        highest("current_status"),
        highest("route_id"),
        highest("stop_id"),
        F.col("_first.ts").alias("first_timestamp"),
        F.expr(f"{last}.ts").alias("last_timestamp"),
        F.col("_first.lat").alias("first_lat"),
        F.col("_first.lon").alias("first_lon"),
        F.expr(f"{last}.lat").alias("last_lat"),
        F.expr(f"{last}.lon").alias("last_lon"),
    )


def takes_panes(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a checkpoint is new, or its batches have kept their panes in it."""
    files = tables.Files(spark, checkpoint)
    return not files.names("commits") or bool(files.names("panes"))


def _watermark(checkpoint: tables.Files, batch: int) -> int:
    """Whole seconds of a batch's watermark, as the stream noted it before the batch ran."""
    for line in checkpoint.read_text(f"offsets/{batch}").splitlines():
        if line.startswith("{") and "batchWatermarkMs" in line:
            return json.loads(line)["batchWatermarkMs"] // 1000
    raise RuntimeError(f"batch {batch} of the stream has no watermark in its checkpoint")


def append_closed(stream: PaneStream, out: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """What a streaming query of panes does with each micro-batch.

    A batch's panes lie below the checkpoint until the batch after the next one runs. A
    batch that runs again finds those of the batch before it, and replaces its own.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        files = tables.Files(spark, checkpoint)
        upto = _watermark(files, number)
        after = _watermark(files, number - 1) if number else 0
        kept = f"{checkpoint}/panes/{number}"
        with sink.adaptive(spark):
            panes = batch
            if number:
                earlier = spark.read.schema(batch.schema).parquet(f"{checkpoint}/panes/{number - 1}")
                panes = panes.unionByName(earlier.where(F.col("_start") + stream.length > after))
            # the stream's own work is done once, here
            panes.hint("rebalance").write.mode("overwrite").parquet(kept)
            if upto > after:
                closed = spark.read.schema(batch.schema).parquet(kept)
                rows = closed.count() * stream.length / stream.slide
                windows = windows_of_panes(
                    closed,
                    stream.length,
                    stream.slide,
                    after,
                    upto,
                    max(1, math.ceil(rows / WINDOWS_PER_TASK)),
                )
                sink.append_placed(stream.finish(windows), out, number)
        files.delete(f"panes/{number - 2}")

    return write
