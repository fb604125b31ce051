"""Decoding, flags, surrogate keys, array clean-up and audit stamps."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what a NULL part of a surrogate key is replaced with.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def _literal(value) -> str:
    if isinstance(value, int):
        return f"{value}L"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def decode(code: str, mapping: Mapping, default: str = "Unknown") -> Column:
    """Label of ``code``; codes outside the mapping, and NULL, give ``default``."""
    kind = "bigint" if all(isinstance(k, int) for k in mapping) else "string"
    entries = ", ".join(f"{_literal(k)}, {_literal(v)}" for k, v in mapping.items())
    return F.expr(
        f"coalesce(try_element_at(map({entries}), try_cast({code} as {kind})), {_literal(default)})"
    )


def flag_gt(left: str, right: str) -> Column:
    """``left > right`` as a flag: a comparison with NULL is FALSE."""
    return F.expr(f"coalesce(({left}) > ({right}), false)")


def surrogate_key(*parts: str) -> Column:
    """md5 over the parts joined with ``-``."""
    texts = ", ".join(f"coalesce(cast({p} as string), '{NULL_KEY_PART}')" for p in parts)
    return F.expr(f"md5(concat_ws('-', {texts}))")


def compact_arrays(df: DataFrame) -> DataFrame:
    """Drop NULL elements from every array column; a NULL array stays NULL."""
    arrays = {
        f.name: F.array_compact(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType)
    }
    return df.withColumns(arrays) if arrays else df


def with_ingested_at(df: DataFrame, now: datetime | str | None = None) -> DataFrame:
    """Stamp rows with the load time (one value for the whole load).

    A given ``now`` is read in the session's time zone, not the driver machine's.
    """
    stamp = F.current_timestamp() if now is None else F.lit(str(now)).cast("timestamp")
    return df.withColumn("ingested_at", stamp)
