"""Data checks: each returns the failing rows, an empty result means pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their row count."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row count; NULL is not judged."""
    outside = df.where(~F.col(column).isin(list(values)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def minimum_value(df: DataFrame, column: str, minimum) -> DataFrame:
    """Rows where ``column`` is below ``minimum``."""
    return df.where(F.col(column) < F.lit(minimum))


@dataclass(frozen=True)
class Check:
    """One declared test of a column."""

    kind: str
    column: str
    argument: tuple | int | float | None = None

    @property
    def row_condition(self) -> Column | None:
        """Failing-row test for kinds judged row by row."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "minimum_value":
            return F.col(self.column) < F.lit(self.argument)
        return None

    def failing(self, df: DataFrame) -> DataFrame:
        if self.kind == "not_null":
            return not_null(df, self.column)
        if self.kind == "unique":
            return unique(df, self.column)
        if self.kind == "accepted_values":
            return accepted_values(df, self.column, self.argument)
        if self.kind == "minimum_value":
            return minimum_value(df, self.column, self.argument)
        raise ValueError(f"unknown check {self.kind!r}")


class QualityError(RuntimeError):
    """A gated table failed its checks."""


def _marks(checks: Sequence[Check]) -> list[Column]:
    """Per check what a row has to say: nothing, that it fails, or a value to be counted."""
    marks = []
    for i, c in enumerate(checks):
        column = F.col(c.column)
        if c.row_condition is not None:
            told, key = c.row_condition, F.lit(None).cast("string")
        elif c.kind == "unique":
            told, key = column.isNotNull(), column.cast("string")
        elif c.kind == "accepted_values":
            told, key = ~column.isin(list(c.argument)), column.cast("string")
        else:
            raise ValueError(f"unknown check {c.kind!r}")
        marks.append(F.when(told, F.struct(F.lit(i).alias("n"), key.alias("key"))))
    return marks


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check, column, failures)``, one row per check.

    All checks share one scan: a row says which row-wise checks it fails and which values
    it holds in columns judged by group. These marks are counted before the one shuffle,
    and a second small sum gives the failures of each check.
    """
    row_wise = [i for i, c in enumerate(checks) if c.row_condition is not None]
    by_value = [i for i, c in enumerate(checks) if c.kind == "unique"]
    found = (
        df.select(F.explode(F.array_compact(F.array(*_marks(checks)))).alias("m"))
        .groupBy("m.n", "m.key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    failures = (
        F.when(F.col("n").isin(row_wise), F.col("rows"))
        .when(F.col("n").isin(by_value), (F.col("rows") > 1).cast("bigint"))
        .otherwise(F.lit(1).cast("bigint"))
    )
    counts = found.groupBy("n").agg(F.sum(failures).alias("failures"))
    declared = F.array(
        *[
            F.struct(F.lit(i).alias("n"), F.lit(c.kind).alias("check"), F.lit(c.column).alias("column"))
            for i, c in enumerate(checks)
        ]
    )
    # one row per check on either side
    return (
        df.sparkSession.range(1)
        .select(F.inline(declared))
        .join(F.broadcast(counts), "n", "left")
        .select("check", "column", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"))
    )


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation | None]:
    """``df`` that counts the failures of row-wise checks while it is written."""
    conditions = [c.row_condition for c in checks if c.row_condition is not None]
    if not conditions:
        return df, None
    observation = Observation()
    counts = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions)]
    return df.observe(observation, *counts), observation


def failures_after_write(
    written: DataFrame, checks: Sequence[Check], observation: Observation | None
) -> dict[tuple[str, str], int]:
    """Failures per check: row-wise ones as observed, the others by one scan of their columns."""
    row_wise = [c for c in checks if c.row_condition is not None]
    grouped = [c for c in checks if c.row_condition is None]
    out = {}
    if observation is not None:
        seen = observation.get
        out = {(c.kind, c.column): seen[f"c{i}"] for i, c in enumerate(row_wise)}
    if grouped:
        for row in run_suite(written, grouped).collect():
            out[row["check"], row["column"]] = row["failures"]
    return out


def require(df: DataFrame, checks: Sequence[Check], name: str) -> dict[tuple[str, str], int]:
    """Run a suite and raise if anything fails; returns the counts.

    Only the one small row per check reaches the driver.
    """
    counts = {(r["check"], r["column"]): r["failures"] for r in run_suite(df, checks).collect()}
    failed = {k: n for k, n in counts.items() if n}
    if failed:
        listed = ", ".join(f"{kind}({column}): {n}" for (kind, column), n in failed.items())
        raise QualityError(f"{name}: {listed}")
    return counts
