"""Time of day in schedule feeds, where the hour may be 24 or more.

A time is carried as whole seconds (INT), which hash aggregation and shuffles
handle in place, and shown as ``HH:mm:ss`` text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
DAY_MINUTES = 1_440


def _to_seconds(text: str) -> str:
    # the digits as one number HHMMSS; the shape is checked on the colons, which
    # is several times cheaper per row than a regular expression and three splits
    t = f"trim({text})"
    digits = f"replace({t}, ':', '')"
    n = f"try_cast({digits} as int)"
    shape = (
        f"length({t}) between 7 and 9 and length({digits}) = length({t}) - 2 "
        f"and substr({t}, -3, 1) = ':' and substr({t}, -6, 1) = ':' "
        f"and substr({t}, 1, 1) between '0' and '9'"
    )
    ranges = f"{n} % 100 < 60 and {n} div 100 % 100 < 60"
    value = f"{n} div 10000 * 3600 + {n} div 100 % 100 * 60 + {n} % 100"
    return f"(case when {shape} and {ranges} then cast({value} as int) end)"


def to_seconds(text: str) -> Column:
    """``H:MM:SS`` to seconds since the start of the service day; else NULL.

    One to three hour digits; the hour is not wrapped: ``25:30:10`` is 91,810.
    """
    return F.expr(_to_seconds(text))


def _second_of_day(seconds: str) -> str:
    return f"cast(pmod({seconds}, {DAY_SECONDS}) as int)"


def second_of_day(seconds: str) -> Column:
    """Fold a service-day time into 0..86,399."""
    return F.expr(_second_of_day(seconds))


def day_offset(text: str) -> Column:
    """How many calendar days after the service day a feed time falls."""
    return F.expr(f"cast({_to_seconds(text)} div {DAY_SECONDS} as int)")


def _seconds_to_text(s: str) -> str:
    two = lambda part: f"lpad(cast({part} as string), 2, '0')"
    return (
        f"concat({two(f'({s}) div 3600')}, ':', {two(f'({s}) div 60 % 60')}, ':', "
        f"{two(f'({s}) % 60')})"
    )


def seconds_to_text(seconds: str) -> Column:
    """Seconds of day as ``HH:mm:ss``; NULL stays NULL."""
    return F.expr(_seconds_to_text(seconds))


def seconds_of(df: DataFrame, seconds: str, text: str) -> Column:
    """The integer column of a clock time if the frame has it, else its text parsed."""
    return F.col(seconds) if seconds in df.columns else to_seconds(text)


def normalize(text: str) -> Column:
    """A feed time as a clock time: ``25:30:10`` becomes ``01:30:10``."""
    return F.expr(_seconds_to_text(_second_of_day(_to_seconds(text))))


def as_time(text: str) -> Column:
    """Clock time as Spark's TIME type (needs ``spark.sql.timeType.enabled``)."""
    return F.try_to_time(normalize(text))


def duration_minutes(start: str, end: str) -> Column:
    """Trip minutes from seconds of day, as minute boundaries crossed.

    An end before the start means the trip crossed midnight.
    """
    crossed = f"abs({end} div 60 - {start} div 60)"
    return F.expr(
        f"cast(case when {end} < {start} then {DAY_MINUTES} - {crossed} else {crossed} end as int)"
    )


def delay_seconds(real: str, planned: str) -> Column:
    """Signed delay as plain subtraction (no midnight correction)."""
    return F.expr(f"cast(({real}) - ({planned}) as bigint)")


def wrapped_delay_seconds(real: str, planned: str) -> Column:
    """Signed delay folded into plus or minus twelve hours."""
    half = DAY_SECONDS // 2
    return F.expr(
        f"cast(pmod(({real}) - ({planned}) + {half}, {DAY_SECONDS}) - {half} as bigint)"
    )


def as_interval(seconds: str) -> Column:
    """Seconds as a day-time interval."""
    return F.expr(f"make_dt_interval(0, 0, 0, cast({seconds} as decimal(18, 6)))")


def minute_of_timestamp(ts: str) -> Column:
    """Second of day of a timestamp, cut to the minute (session time zone)."""
    return F.expr(f"cast(hour({ts}) * 3600 + minute({ts}) * 60 as int)")
