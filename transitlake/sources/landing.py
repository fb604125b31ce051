"""Dated landing folders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _root(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_landing(df: DataFrame, root: str, name: str, execution_date: date | str) -> None:
    """Write one day of a feed; the day's earlier write, if any, is replaced."""
    day_folder = f"{_root(root, name)}/execution_date={execution_date}"
    df.write.mode("overwrite").parquet(day_folder)


def write_landing_partitioned(df: DataFrame, root: str, name: str, day: str) -> None:
    """Write many days at once, one folder per value of ``day``.

    Rows are regrouped by day under a rebalance hint: large days are split over
    several tasks, small ones share a task, and each day gets few files.
    """
    dated = df.withColumnRenamed(day, "execution_date").hint("rebalance", "execution_date")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("execution_date")
        .parquet(_root(root, name))
    )


def read_landing(
    spark: SparkSession, root: str, name: str, execution_date: date | str | None = None
) -> DataFrame:
    """Read a landed feed; with a date only that day's folder is listed as input."""
    df = spark.read.parquet(_root(root, name))
    if execution_date is None:
        return df
    return df.where(F.col("execution_date") == F.lit(str(execution_date)).cast("date"))
