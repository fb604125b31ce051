"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    # exact, and 0.0 is not -0.0: both sides round for themselves
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def _kind(text: str) -> str:
    return {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}.get(
        text, text
    )


def compare(spark, con, run, sql, folder) -> list[str]:
    """Differences found; empty means equal. Raises nothing on mismatch."""
    got = run(spark, folder)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    kinds = {d[0]: _kind(str(d[1])) for d in want.description}
    problems = []
    if sorted(got.columns) != sorted(names):
        return [f"columns {sorted(got.columns)} != {sorted(names)}"]
    spark_kinds = dict(got.dtypes)
    for n in names:
        if kinds[n] != spark_kinds[n]:
            problems.append(f"type of {n}: {spark_kinds[n]} != {kinds[n]}")
    ours = _bag(got.columns, [tuple(r) for r in got.collect()])
    theirs = _bag(names, want.fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        problems.append(
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; "
            f"{sum(extra.values())} extra e.g. {list(extra)[:3]}; "
            f"{sum(missing.values())} missing e.g. {list(missing)[:3]}"
        )
    return problems
