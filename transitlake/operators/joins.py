"""Joins on array membership, and unnesting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEMBER = "_member"


def unnest(df: DataFrame, array: str, alias: str) -> DataFrame:
    """One row per array element; rows with an empty or NULL array disappear."""
    return df.withColumn(alias, F.explode(array))


def _with_members(left: DataFrame, array: str) -> DataFrame:
    # an id repeated inside one array still matches once
    return left.withColumn(MEMBER, F.explode_outer(F.array_distinct(array)))


def array_member_fold(
    left: DataFrame,
    array: str,
    right: DataFrame,
    key: str,
    group_by: Sequence[str],
    aggs: Sequence[Column],
) -> DataFrame:
    """Left join on "key is an element of array", folded back to ``group_by``.

    The membership test becomes an equi-join on the exploded element, so it
    runs as a hash or sort-merge join and never as a nested loop. Elements that
    find no partner contribute only NULLs, which aggregates skip.
    """
    joined = _with_members(left, array).join(right, F.col(MEMBER) == right[key], "left")
    return joined.groupBy(*group_by).agg(*aggs)


def array_member_left(
    left: DataFrame, array: str, right: DataFrame, key: str, left_id: str
) -> DataFrame:
    """Left join on "key is an element of array", one row per match.

    A left row without any match stays once. ``left_id`` must identify a left
    row: it brings the few rows made from one array back together.
    """
    joined = _with_members(left, array).join(right, F.col(MEMBER) == right[key], "left")
    matched = F.col(key).isNotNull()
    per_row = Window.partitionBy(left_id)
    ranked = joined.withColumns(
        {
            "_any": F.max(matched).over(per_row),
            "_nth": F.row_number().over(per_row.orderBy(matched.desc(), MEMBER)),
        }
    )
    keep = matched | (~F.col("_any") & (F.col("_nth") == 1))
    return ranked.where(keep).drop(MEMBER, "_any", "_nth")
