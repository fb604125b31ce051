"""Looking at the previous row of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    segment: str | Column | None = None,
) -> DataFrame:
    """Add ``out``: the value of the preceding row of the key, NULL for its first row.

    ``order`` should identify a row within its key. ``segment`` (a column or an SQL
    expression) cuts a key's rows into segments and must never decrease along ``order``,
    as ``date_trunc('DAY', ts)`` for rows ordered by ``ts``. Rows are placed by key and
    segment, so a key of any size is worked on by as many tasks as it has segments. The
    first row of a segment takes its value from the last row of the key's segment before,
    however many empty ones lie between: the first and last rows alone are placed by key
    once more. The input is read and shuffled once; nothing is counted or written.

    A segment should hold many rows of a busy key and is sorted by one task; a key with a
    row per segment moves twice. Without ``segment`` a key is one task's work: for inputs
    with a bounded number of rows per key.
    """
    whole = Window.partitionBy(*keys).orderBy(*order)
    if segment is None:
        return df.select("*", F.lag(value).over(whole).alias(out))

    part = F.expr(segment) if isinstance(segment, str) else segment
    within = Window.partitionBy(*keys, "_segment").orderBy(*order)
    rows = df.withColumn("_segment", part).withColumns(
        {
            "_before": F.lag(value).over(within),
            "_first": F.lag(F.lit(True), 1, False).over(within) == F.lit(False),
            "_last": F.lead(F.lit(True), 1, False).over(within) == F.lit(False),
        }
    )
    # both branches read the one shuffle below the windows
    inner = rows.where(~F.col("_first")).select(*df.columns, F.col("_before").alias(out))
    edges = rows.where(F.col("_first") | F.col("_last")).select(
        *df.columns, "_first", F.lag(value).over(whole).alias(out)
    )
    return inner.unionByName(edges.where("_first").drop("_first"))
