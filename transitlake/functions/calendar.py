"""Calendar attributes of a day and generated date dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_LAST_YEAR = "add_months(d, -12)"


def _sunday_week(day: str) -> str:
    """Week of the year counted from the first Sunday; 0 before it."""
    return f"cast((dayofyear({day}) + 7 - dayofweek({day})) div 7 as int)"


def _week_start(day: str) -> str:
    return f"date_sub({day}, dayofweek({day}) - 1)"


ATTRIBUTES: dict[str, str] = {
    "date_day": "d",
    "prior_date_day": "date_sub(d, 1)",
    "next_date_day": "date_add(d, 1)",
    "prior_year_date_day": _LAST_YEAR,
    # the same weekday one year earlier: 52 whole weeks back
    "prior_year_over_year_date_day": "date_sub(d, 364)",
    "day_of_week": "dayofweek(d)",
    "day_of_week_name": "date_format(d, 'EEEE')",
    "day_of_week_name_short": "date_format(d, 'EEE')",
    "day_of_month": "dayofmonth(d)",
    "day_of_year": "dayofyear(d)",
    "week_start_date": _week_start("d"),
    "week_end_date": f"date_add({_week_start('d')}, 6)",
    "prior_year_week_start_date": _week_start(_LAST_YEAR),
    "prior_year_week_end_date": f"date_add({_week_start(_LAST_YEAR)}, 6)",
    "week_of_year": _sunday_week("d"),
    "iso_week_start_date": "trunc(d, 'week')",
    "iso_week_end_date": "date_add(trunc(d, 'week'), 6)",
    "prior_year_iso_week_start_date": f"trunc({_LAST_YEAR}, 'week')",
    "prior_year_iso_week_end_date": f"date_add(trunc({_LAST_YEAR}, 'week'), 6)",
    "iso_week_of_year": "weekofyear(d)",
    "prior_year_week_of_year": _sunday_week(_LAST_YEAR),
    "prior_year_iso_week_of_year": f"weekofyear({_LAST_YEAR})",
    "month_of_year": "month(d)",
    "month_name": "date_format(d, 'MMMM')",
    "month_name_short": "date_format(d, 'MMM')",
    "month_start_date": "trunc(d, 'month')",
    "month_end_date": "last_day(d)",
    "prior_year_month_start_date": f"trunc({_LAST_YEAR}, 'month')",
    "prior_year_month_end_date": f"last_day({_LAST_YEAR})",
    "quarter_of_year": "quarter(d)",
    "quarter_start_date": "trunc(d, 'quarter')",
    "quarter_end_date": "date_sub(add_months(trunc(d, 'quarter'), 3), 1)",
    "year_number": "year(d)",
    "year_start_date": "trunc(d, 'year')",
    "year_end_date": "date_sub(add_months(trunc(d, 'year'), 12), 1)",
}


def with_attributes(days: DataFrame) -> DataFrame:
    """The 35 calendar attributes of a one-column frame of dates."""
    return days.toDF("d").selectExpr(*[f"{e} as {name}" for name, e in ATTRIBUTES.items()])


def date_dimension(
    spark: SparkSession, start: str, end: str, end_inclusive: bool = False
) -> DataFrame:
    """One row per day from ``start``; the end day is left out by default."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    if not end_inclusive:
        last = F.date_sub(last, 1)
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date_day"))
    return with_attributes(days)


def date_dimension_over(df: DataFrame, day: str) -> DataFrame:
    """Date dimension spanning the days found in ``df[day]``, both ends included.

    The range is a two-value aggregate; it is exploded lazily, so nothing is
    brought to the driver.
    """
    span = df.agg(F.min(F.to_date(day)).alias("a"), F.max(F.to_date(day)).alias("b"))
    days = span.where(F.col("a").isNotNull()).select(
        F.explode(F.sequence(F.col("a"), F.col("b"))).alias("date_day")
    )
    return with_attributes(days)
