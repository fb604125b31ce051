"""Keep the latest version, or the first and last row, of every key.

A key may hold a large share of all rows, so both operators reduce every map
task to at most a row or two per key before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_row_rank"


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    version: str | Column,
    tiebreak: Sequence[str | Column] = (),
) -> DataFrame:
    """The row with the highest ``version`` per key; NULL versions rank last.

    Rows that tie on ``version`` are decided by ``tiebreak`` (highest first).
    Spark plans ``row_number() = 1`` with a partial group limit, so a hot key
    sends one row per map task.
    """
    order = [c.desc_nulls_last() for c in _cols([version, *tiebreak])]
    window = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)


def endpoints_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """First and last row of every key; a key with a single row gives one row.

    One aggregation with map-side combine instead of two windows. ``order``
    should identify a row within its key; NULLs come first.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    position = F.struct(*_cols(order))
    ends = df.groupBy(*keys).agg(
        F.min_by(row, position).alias("_first"),
        F.max_by(row, position).alias("_last"),
        F.count(F.lit(1)).alias("_rows"),
    )
    picked = F.when(F.col("_rows") == 1, F.array("_first")).otherwise(F.array("_first", "_last"))
    return ends.select(F.explode(picked).alias("_row")).select("_row.*")
