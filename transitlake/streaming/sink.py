"""The stream's stored windows: parquet by day and batch.

``day`` is the day a window starts, ``batch`` the micro-batch that closed it. A batch
overwrites exactly its own folders, so one that failed half-way and is run again leaves
no row twice. ``batch`` below zero is a compacted folder: ``-(n + 1)`` holds all that
batches up to ``n`` wrote for the day.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.sources import tables


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for what is planned within; the session of a stream has it off.

    Without it a rebalance hint would be passed over: every task would write a file for
    every day. The batch itself is planned already.
    """
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def _write(df: DataFrame, out: str) -> None:
    (
        df.write.partitionBy("day", "batch")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(out)
    )


def _dated(batch: DataFrame, number: int) -> DataFrame:
    day = F.to_date("window.start").alias("day")
    return batch.select("*", day, F.lit(number).cast("bigint").alias("batch"))


def append_batch(out: str) -> Callable[[DataFrame, int], None]:
    """What a streaming query does with each micro-batch."""

    def write(batch: DataFrame, number: int) -> None:
        # a day's rows of a batch are few: one file, or several if they are many
        with adaptive(batch.sparkSession):
            _write(_dated(batch, number).hint("rebalance", "day"), out)

    return write


def append_placed(batch: DataFrame, out: str, number: int) -> None:
    """Append a batch of which each task holds few days; its rows stay in their tasks."""
    _write(_dated(batch, number), out)


def stored_batches(spark: SparkSession, out: str) -> dict[date, list[int]]:
    """Days with their batches, by the names of folders alone."""
    files = tables.Files(spark, out)
    found = {}
    for name in files.names(""):
        if name.startswith("day=") and name != "day=__HIVE_DEFAULT_PARTITION__":
            numbers = [
                int(n.removeprefix("batch=")) for n in files.names(name) if n.startswith("batch=")
            ]
            if numbers:
                found[date.fromisoformat(name.removeprefix("day="))] = sorted(numbers)
    return found


def read_windows(
    spark: SparkSession, out: str, schema: T.StructType, since: date | None = None
) -> DataFrame:
    """The stored windows in ``schema``; of days from ``since`` on only, if given.

    Folders that a compaction has taken in, but could not remove yet, are passed over.
    """
    days = {d: b for d, b in stored_batches(spark, out).items() if since is None or d >= since}
    paths = [
        f"{out}/day={day}/batch={number}"
        for day, numbers in sorted(days.items())
        for number in _current(numbers)
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _current(numbers: list[int]) -> list[int]:
    """Batches to read: the widest compacted folder and those that came after it."""
    if numbers[0] >= 0:
        return numbers
    return [numbers[0], *[n for n in numbers if n > -numbers[0] - 1]]


def recent_windows(
    spark: SparkSession, out: str, schema: T.StructType, seconds: int
) -> DataFrame:
    """Windows of the newest days, enough to hold the last ``seconds`` before the newest row.

    Older days are not opened, however long the history is.
    """
    days = stored_batches(spark, out)
    if not days:
        return spark.createDataFrame([], schema)
    # a window starts before the rows it holds: one more day covers that, too
    since = max(days) - timedelta(days=1 + seconds // 86_400)
    return read_windows(spark, out, schema, since)


def compact(spark: SparkSession, out: str, schema: T.StructType, day: date) -> int:
    """Put a day's batches into one folder; returns how many folders became one.

    The newest batch of the sink stays as it is, since it may be run again. Readers see
    each window once at any moment: the new folder appears complete and counts
    instead of the old ones from then on; those are removed afterwards.
    """
    batches = stored_batches(spark, out)
    if day not in batches:
        return 0
    newest = max(n for numbers in batches.values() for n in numbers)
    files = tables.Files(spark, out)
    current = _current(batches[day])
    old = [n for n in current if n < newest]
    if len(old) > 1:
        # what the last of them stands for, compacted or not
        upto = max(old[-1], -old[0] - 1)
        aside = f"_compacting/day={day}"
        files.delete(aside)
        paths = [f"{out}/day={day}/batch={n}" for n in old]
        spark.read.schema(schema).parquet(*paths).hint("rebalance").write.parquet(f"{out}/{aside}")
        files.rename(aside, f"day={day}/batch={-(upto + 1)}")
        current = [n for n in current if n not in old]
    for n in batches[day]:
        if n not in current:
            files.delete(f"day={day}/batch={n}")
    return len(old) if len(old) > 1 else 0
