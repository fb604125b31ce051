"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _rounded(x: str) -> str:
    """Six digits, rounded in binary as SQL engines do; large numbers as they are.

    (Spark's own ``round`` works on the decimal text of a number, and differs in
    the last digit where that text ends in 5.)
    """
    scaled = f"floor(abs({x}) * 1e6D + 0.5D) / 1e6D"
    return f"case when abs({x}) < 1e12D then signum({x}) * {scaled} + 0D else {x} end"


def plain(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: bigint, double (6 digits), text, boolean."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.expr(_rounded(f"cast(`{f.name}` as double)"))
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",", "NULL")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn`` under ``name`` with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(use_utc(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
