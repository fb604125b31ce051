"""Vehicle pings to sliding-window motion metrics.

The same transformations run on a batch frame, where the watermark has no
effect; there they serve backfills and comparison with SQL.
"""

from __future__ import annotations

import math
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transitlake.functions.geo import with_motion
from transitlake.schemas import PING
from transitlake.streaming.late import late_rows
from transitlake.streaming.panes import (
    PaneStream,
    append_closed,
    state_on_disk,
    stored_form,
    takes_panes,
)
from transitlake.streaming.sink import append_batch

# Fixed values of the running job.
WINDOW_LENGTH = "2 minutes"
WINDOW_SLIDE = "30 seconds"
WATERMARK = "3 minutes"
TRIGGER = "10 seconds"


def read_pings(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON ping files as a stream.

    ``max_files`` bounds one micro-batch. With a bound, files must come in order of
    event time: a backlog whose files overlap by more than the watermark would lose
    rows as late. By default a batch takes all files that are there.
    """
    reader = spark.readStream.format("json").schema(PING)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_event_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Epoch seconds to an event-time timestamp."""
    return df.withColumn(column, F.timestamp_seconds(F.col(column)))


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(duration: str) -> int:
    """'2 minutes' to 120."""
    number, unit = duration.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def aggregate_panes(
    df: DataFrame,
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """One row per vehicle, trip and pane; see :func:`aggregate_pings`."""
    fix = F.struct(
        F.col("timestamp").alias("ts"), F.col("lat").alias("lat"), F.col("lon").alias("lon")
    )
    pane = f"{math.gcd(_seconds(length), _seconds(slide))} seconds"
    return (
        df.withWatermark("timestamp", watermark)
        .groupBy("id", "trip_id", F.window("timestamp", pane).alias("_pane"))
        .agg(
            F.max("current_status").alias("current_status"),
            F.max("route_id").alias("route_id"),
            F.max("stop_id").alias("stop_id"),
            F.min(fix).alias("_first"),
            F.max(fix).alias("_last"),
        )
    )


def aggregate_pings(
    df: DataFrame,
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """One row per vehicle, trip and sliding window.

    First and last position are chosen by event time, ties by coordinates, so
    the result does not depend on arrival order. Status, route and stop are the
    highest text of the window, as in the original job.

    A ping is aggregated once, into the pane it falls in: panes follow each other and
    both length and slide are whole numbers of them. Windows are put together from
    panes, so what is copied per overlapping window is a row per vehicle, trip and pane.
    On a stream a ping is late when its pane has closed, so a ping that is later than the
    watermark allows is left out of all its windows alike.
    """
    panes = aggregate_panes(df, length, slide, watermark)
    if not df.isStreaming:
        # adaptive execution sizes tasks by the panes they read, of which each makes up to
        # length / slide rows: a stated number of tasks is not merged. A busy vehicle is
        # spread by hours
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hour = F.date_trunc("hour", F.col("_pane.start"))
        panes = panes.repartition(tasks, F.col("id"), F.col("trip_id"), hour)
    windows = panes.groupBy("id", "trip_id", F.window("_pane", length, slide).alias("window")).agg(
        F.max("current_status").alias("current_status"),
        F.max("route_id").alias("route_id"),
        F.max("stop_id").alias("stop_id"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    return windows.select(
        "id",
        "trip_id",
        "window",
        "current_status",
        "route_id",
        "stop_id",
        F.col("_first.ts").alias("first_timestamp"),
        F.col("_last.ts").alias("last_timestamp"),
        F.col("_first.lat").alias("first_lat"),
        F.col("_first.lon").alias("first_lon"),
        F.col("_last.lat").alias("last_lat"),
        F.col("_last.lon").alias("last_lon"),
    )


def vehicle_windows(pings: DataFrame, **window) -> DataFrame:
    """Raw pings (epoch seconds) to windows with distance, time and speed."""
    timed = pings.transform(with_event_time)
    windows = timed.transform(aggregate_pings, **window).transform(with_motion)
    if pings.isStreaming:
        # the sink can make the same windows of closed panes (:func:`write_windows`). What
        # a caller derives from the frame does not have this, and runs as it is planned
        windows.made_of = PaneStream(
            stored_form(aggregate_panes(timed, **window)),
            _seconds(window.get("length", WINDOW_LENGTH)),
            _seconds(window.get("slide", WINDOW_SLIDE)),
            with_motion,
        )
    return windows


def write_windows(
    df: DataFrame,
    out: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Start the parquet sink in append mode: a window is written once, when closed.

    Windows lie by day and batch (:mod:`transitlake.streaming.sink`), so a batch that
    is run again after a failure replaces what it had written. ``trigger=None`` works off
    what is there and stops. The checkpoint is the stream's memory across restarts; it is
    never cleared here.

    Of a stream as :func:`vehicle_windows` returns it, Spark keeps open panes alone as state,
    on disk, and each batch makes its windows of closed panes
    (:mod:`transitlake.streaming.panes`). A checkpoint that was begun without panes is
    continued as it was begun.
    """
    # counts from the first batch on
    spark = df.sparkSession
    late_rows(spark)
    made_of = getattr(df, "made_of", None)
    of_panes = made_of is not None and takes_panes(spark, checkpoint)
    if of_panes:
        rows, append = made_of.panes, append_closed(made_of, out, checkpoint)
    else:
        rows, append = df, append_batch(out)
    writer = (
        rows.writeStream.foreachBatch(append)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if trigger is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    with state_on_disk(spark) if of_panes else nullcontext():
        return writer.start()


def dropped_rows(query: StreamingQuery) -> int:
    """Aggregated rows of all batches of a run that came after the watermark."""
    return late_rows(SparkSession.active()).total(query)


def work_off(query: StreamingQuery) -> None:
    """Wait until a query that works off a backlog ends, without a limit.

    A failure of the query is raised, and so is any row dropped as late.
    """
    query.awaitTermination()
    late = dropped_rows(query)
    if late:
        raise RuntimeError(f"{late} rows of the backlog were dropped as late")


def run(query: StreamingQuery, timeout_s: int = 300) -> bool:
    """Wait at most ``timeout_s`` seconds, then stop; True if it ended by itself."""
    ended = query.awaitTermination(timeout_s)
    if not ended:
        query.stop()
    return bool(ended)
