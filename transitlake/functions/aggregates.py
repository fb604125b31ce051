"""Aggregate expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def string_agg(value: Column, sep: str = ";", order_by: Column | None = None) -> Column:
    """Delimited text of the non-NULL values of a group, in a fixed order.

    Ordered by ``order_by`` and then by the value; NULL when a group has no
    value at all. The text is the result, so its length is that of the group.
    """
    value = value.cast("string")
    order = value if order_by is None else order_by
    pairs = F.array_sort(
        F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    )
    return join_field(pairs, "v", sep)


def ordered_rows(order_by: Column, keep: Column | None = None, **fields: Column) -> Column:
    """Collect the rows of a group (those that ``keep`` accepts) as a sorted array.

    Texts cut from one such array with :func:`join_field` line up by position.
    """
    named = [column.alias(name) for name, column in fields.items()]
    row = F.struct(order_by.alias("_order"), *named)
    return F.array_sort(F.collect_list(row if keep is None else F.when(keep, row)))


def join_field(rows: Column, field: str, sep: str = ";") -> Column:
    """Join one field of an array of structs, NULLs skipped; NULL if nothing is left."""
    values = F.array_compact(F.transform(rows, lambda r: r[field].cast("string")))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def ordered_texts(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    piece: str | Column,
    sep: str = ";",
    **fields: str,
) -> DataFrame:
    """Per group one delimited text of each field, in the order of ``order``.

    ``piece`` (a column or an SQL expression) must never decrease along ``order``, as a
    prefix of a text does. A group's rows are sorted and joined piece by piece, by as many
    tasks as there are pieces, and the pieces' texts are put together in turn; so a group
    that holds much of the table is one task's work only as a handful of finished texts.
    Texts line up by position unless a field is NULL, which is skipped; a group without any
    value has NULL. The texts are the result, so their length is that of the group.
    """
    part = F.expr(piece) if isinstance(piece, str) else piece
    rows = ordered_rows(F.col(order), **{name: F.col(column) for name, column in fields.items()})
    pieces = (
        df.withColumn("_piece", part)
        .groupBy(*keys, "_piece")
        .agg(rows.alias("_rows"))
        .select(*keys, "_piece", *[join_field(F.col("_rows"), n, sep).alias(n) for n in fields])
    )
    whole = ordered_rows(F.col("_piece"), **{n: F.col(n) for n in fields})
    return (
        pieces.groupBy(*keys)
        .agg(whole.alias("_pieces"))
        .select(*keys, *[join_field(F.col("_pieces"), n, sep).alias(n) for n in fields])
    )
