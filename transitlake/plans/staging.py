"""Raw feeds to cleaned staging relations.

Clock times come out as ``HH:mm:ss`` text, with the same time in whole seconds
beside it (``*_s``) for the models that calculate with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.functions import gtfs_time as gt
from transitlake.functions.aggregates import join_field, ordered_rows
from transitlake.functions.calendar import date_dimension
from transitlake.functions.clean import decode
from transitlake.operators.dedupe import latest_per_key
from transitlake.operators.joins import array_member_fold

# Label of a day whose period is not listed.
OTHER_PERIOD = "Outros"

# Weather code tables.
WIND_SPEED = {1: "Weak", 2: "Moderate", 3: "Strong", 4: "Very strong"}
PRECIPITATION = {0: "No precipitation", 1: "Weak", 2: "Moderate", 3: "Strong"}
WEATHER_TYPE = {
    1: "Clear sky",
    2: "Partly cloudy",
    3: "Sunny intervals",
    4: "Cloudy",
    5: "Cloudy (High cloud)",
    6: "Showers/rain",
    7: "Light showers/rain",
    8: "Heavy showers/rain",
    9: "Rain/showers",
    10: "Light rain",
    11: "Heavy rain/showers",
    12: "Intermittent rain",
    13: "Intermittent light rain",
    14: "Intermittent heavy rain",
    15: "Drizzle",
    16: "Mist",
    17: "Fog",
    18: "Snow",
    19: "Thunderstorms",
    20: "Showers and thunderstorms",
    21: "Hail",
    22: "Frost",
    23: "Rain and thunderstorms",
    24: "Convective clouds",
    25: "Partly cloudy",
    26: "Fog",
    27: "Cloudy",
    28: "Snow showers",
    29: "Rain and snow",
    30: "Rain and snow",
}

# Room for the departure time (up to 999 hours) below the stop sequence.
_SEQUENCE_STEP = 1 << 22

# The generated calendar, last day excluded.
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2030-12-31"


def stop_times(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    """One row per trip: first and last departure, last distance, number of stops.

    First and last stop are taken by (stop_sequence, departure_time), packed
    into one long, so a single hash aggregation with map-side combine does it
    without a sort. A trip with one stop has no start time. ``dedupe`` drops
    exact copies of a stop before counting.
    """
    stops = raw.select(
        "trip_id",
        F.col("stop_sequence").cast("bigint").alias("seq"),
        gt.to_seconds("departure_time").alias("dep"),
        F.col("shape_dist_traveled").cast("double").alias("dist"),
    )
    if dedupe:
        stops = stops.distinct()
    # NULL sorts first in both parts
    placed = stops.selectExpr(
        "trip_id",
        "dist",
        f"coalesce(seq, -1L) * {_SEQUENCE_STEP} + coalesce(dep + 1, 0) as position",
    )
    ends = placed.groupBy("trip_id").agg(
        F.min("position").alias("first"),
        F.max("position").alias("last"),
        F.max_by("dist", "position").alias("shape_dist_traveled"),
        F.count(F.lit(1)).alias("number_of_stops"),
    )
    # the packed departure part is 0 where the departure is NULL
    departure = lambda packed: (
        f"cast(pmod(nullif(pmod({packed}, {_SEQUENCE_STEP}), 0) - 1, {gt.DAY_SECONDS}) as int)"
    )
    seconds = ends.selectExpr(
        "trip_id",
        "shape_dist_traveled",
        "number_of_stops",
        f"case when number_of_stops > 1 then {departure('first')} end as scheduled_start_s",
        f"{departure('last')} as scheduled_end_s",
        f"nullif(cast(floor(last / {_SEQUENCE_STEP}) as int), -1) as stop_sequence",
    )
    return seconds.select(
        gt.seconds_to_text("scheduled_start_s").alias("scheduled_start_time"),
        gt.seconds_to_text("scheduled_end_s").alias("scheduled_end_time"),
        "stop_sequence",
        "shape_dist_traveled",
        "trip_id",
        "number_of_stops",
        "scheduled_start_s",
        "scheduled_end_s",
    )


def real_stop_times(raw: DataFrame, feed_tz: str = "UTC", by_day: bool = False) -> DataFrame:
    """First and last observed time of every trip, cut to the minute.

    ``feed_tz`` shows the times in a local zone. ``by_day`` keeps the days of a
    trip apart; by default a trip is one row over all of its history.
    """
    local = F.from_utc_timestamp(F.col("timestamp"), feed_tz) if feed_tz != "UTC" else F.col(
        "timestamp"
    )
    seen = raw.select("trip_id", local.cast("timestamp").alias("seen_at"))
    keys = ["trip_id"]
    if by_day:
        seen = seen.withColumn("trip_day", F.to_date("seen_at"))
        keys.append("trip_day")
    ends = seen.groupBy(*keys).agg(F.min("seen_at").alias("a"), F.max("seen_at").alias("b"))
    seconds = ends.select(
        "trip_id",
        F.to_date("a").alias("trip_date"),
        gt.minute_of_timestamp("a").alias("real_start_s"),
        gt.minute_of_timestamp("b").alias("real_end_s"),
    )
    return seconds.select(
        "trip_id",
        "trip_date",
        gt.seconds_to_text("real_start_s").alias("real_start_time"),
        gt.seconds_to_text("real_end_s").alias("real_end_time"),
        "real_start_s",
        "real_end_s",
    )


def calendar_dates(raw: DataFrame, periods: DataFrame) -> DataFrame:
    """Service days with the name of their period."""
    named = periods.select(F.col("period_id"), F.col("period_name"))
    return raw.join(named, raw["period"] == named["period_id"], "left").select(
        F.try_to_date(F.col("date").cast("string"), "yyyyMMdd").alias("date"),
        F.col("day_type").cast("bigint").alias("day_type"),
        F.col("exception_type").cast("bigint").alias("exception_type"),
        F.col("holiday").cast("bigint").alias("holiday"),
        F.coalesce("period_name", F.lit(OTHER_PERIOD)).alias("period_name"),
        F.col("service_id").cast("string").alias("service_id"),
    )


def dates(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """The generated calendar."""
    return date_dimension(spark, start, end)


def routes(
    raw: DataFrame,
    municipalities: DataFrame,
    dedupe_municipalities: bool = False,
    dedupe_first: bool = False,
) -> DataFrame:
    """Latest version of every route with the municipalities it serves.

    ``dedupe_municipalities`` keeps one version of each municipality.
    ``dedupe_first`` drops old route versions before the join, which is cheaper
    and gives the same rows if (id, ingested_at) is unique.
    """
    if dedupe_municipalities:
        municipalities = latest_per_key(municipalities, ["id"], "ingested_at")
    named = municipalities.select(F.col("id").alias("m_id"), F.col("name").alias("m_name"))
    if dedupe_first:
        raw = latest_per_key(raw, ["id"], "ingested_at")
    folded = array_member_fold(
        raw.select("id", "long_name", "line_id", "ingested_at", "municipalities"),
        "municipalities",
        named,
        "m_id",
        ["id", "long_name", "line_id", "ingested_at"],
        [
            ordered_rows(
                F.col("m_id"), F.col("m_id").isNotNull(), name=F.col("m_name"), id=F.col("m_id")
            ).alias("served")
        ],
    )
    latest = latest_per_key(folded, ["id"], "ingested_at", ["long_name", "line_id"])
    return latest.select(
        F.col("id").alias("route_id"),
        F.col("long_name").alias("route_name"),
        "line_id",
        join_field(F.col("served"), "name").alias("list_municipality_name"),
        join_field(F.col("served"), "id").alias("list_municipality_ids"),
    )


def whole_row(df: DataFrame) -> Column:
    """All columns as text, to decide between versions with one stamp."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]))


def lines(raw: DataFrame) -> DataFrame:
    """Latest version of every line."""
    return latest_per_key(raw, ["id"], "ingested_at", [whole_row(raw)]).select(
        F.col("id").alias("line_id"),
        F.col("long_name").alias("line_name"),
        F.col("routes").alias("list_routes"),
        F.col("patterns").alias("list_patterns"),
    )


def stops(raw: DataFrame) -> DataFrame:
    """Latest version of every stop."""
    return latest_per_key(raw, ["id"], "ingested_at", [whole_row(raw)]).select(
        "stop_id",
        F.col("name").alias("stop_name"),
        "municipality_id",
        "municipality_name",
        "region_name",
        F.col("patterns").alias("list_pattern"),
        "operational_status",
        "routes",
    )


def trips(raw: DataFrame) -> DataFrame:
    """Trip attributes, all versions."""
    return raw.select(
        "trip_id", "route_id", "pattern_id", "service_id", "shape_id", "direction_id"
    )


def weather_data(raw: DataFrame) -> DataFrame:
    """Latest forecast of every day, codes spelled out."""
    return latest_per_key(raw, ["dataPrevisao"], "dataAtualiza", [whole_row(raw)]).select(
        F.try_to_date("dataPrevisao", "yyyy-MM-dd").alias("date"),
        F.col("tMax").try_cast("double").alias("max_temperature"),
        F.col("tMin").try_cast("double").alias("min_temperature"),
        decode("classIntVento", WIND_SPEED).alias("wind_speed_class"),
        decode("classIntPrecipita", PRECIPITATION).alias("precipitation_class"),
        decode("idTipoTempo", WEATHER_TYPE).alias("weather_type"),
    )
