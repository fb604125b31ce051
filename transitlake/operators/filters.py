"""Row filters relative to the data itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_slice(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Rows whose ``ts`` lies strictly within ``seconds`` of the newest one.

    The bound is a scalar subquery: it is worked out by one aggregate, reaches
    the file scan as a filter, and never passes through user code.
    """
    bound = df.agg(
        (F.max(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))).alias("b")
    )
    return df.where(F.col(ts) > bound.scalar())
