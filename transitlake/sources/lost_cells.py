"""Cells of a text feed that its types turn to NULL: counted while loading, kept aside.

A cell is lost if it holds more than blanks and the type of its column cannot read it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.functions.clean import with_ingested_at
from transitlake.sources import tables
from transitlake.sources.files import project_to


def _lost(field: T.StructField) -> Column:
    cell = F.col(f"`{field.name}`")
    return (F.trim(cell) != "") & cell.try_cast(field.dataType).isNull()


def _judged(raw: DataFrame, schema: T.StructType) -> list[T.StructField]:
    """Columns of the schema that the feed has and that are not text."""
    present = set(raw.columns)
    text = (T.StringType, T.VarcharType, T.CharType)
    return [f for f in schema.fields if f.name in present and not isinstance(f.dataType, text)]


def typed_with_counts(
    raw: DataFrame, schema: T.StructType
) -> tuple[DataFrame, Observation | None]:
    """``raw`` (all text) by ``schema``, counting lost cells per column as it is read.

    The observation has a number per judged column once the first action has read all
    rows; it is None if there is nothing to judge.
    """
    fields = _judged(raw, schema)
    if not fields:
        return project_to(raw, schema), None
    watch = Observation()
    counts = [F.count_if(_lost(f)).alias(f.name) for f in fields]
    return project_to(raw.observe(watch, *counts), schema), watch


def lost_cells(
    raw: DataFrame, schema: T.StructType, keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per lost cell: ``record`` (JSON of the ``keep`` columns as read; all by
    default), ``column`` and ``cell``.

    Without lost cells, or without judged columns, no rows. No shuffle.
    """
    fields = _judged(raw, schema)
    record = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keep or raw.columns])).alias("record")
    if not fields:
        none = F.lit(None).cast("string")
        return raw.where("false").select(record, none.alias("column"), none.alias("cell"))
    cells = F.array(
        *[
            F.when(
                _lost(f),
                F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("cell")),
            )
            for f in fields
        ]
    )
    return raw.select(record, F.inline(F.array_compact(cells)))


def land(
    raw: DataFrame,
    schema: T.StructType,
    target: str,
    ledger: str | None = None,
    keep: Sequence[str] | None = None,
    now: datetime | str | None = None,
) -> dict[str, int]:
    """Write ``raw`` by ``schema`` to ``target``; lost cells per column, zeros included.

    The counts come from the write itself, so the text is read once. Only where cells
    were lost, and a ``ledger`` is named, a second read appends them to it with the
    moment of the load.
    """
    typed, watch = typed_with_counts(raw, schema)
    tables.write(typed, target, "overwrite")
    counts = dict(watch.get) if watch is not None else {}
    if ledger is not None and any(counts.values()):
        tables.write(with_ingested_at(lost_cells(raw, schema, keep), now), ledger, "append")
    return counts
