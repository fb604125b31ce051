"""Staging relations to the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.functions import gtfs_time as gt
from transitlake.functions.aggregates import ordered_texts
from transitlake.functions.clean import flag_gt, surrogate_key, with_ingested_at
from transitlake.operators.dedupe import latest_per_key
from transitlake.operators.joins import unnest


def dim_routes(
    routes: DataFrame, lines: DataFrame, stops: DataFrame, now: datetime | None = None
) -> DataFrame:
    """Routes with their line and the stops they call at.

    Stop ids and names are cut from the same sorted lists, so they line up.
    """
    calls = unnest(stops.select("stop_id", "stop_name", "routes"), "routes", "call_route_id")
    route_stops = ordered_texts(
        calls,
        ["call_route_id"],
        "stop_id",
        # stop ids of an area share their first digits
        "substring(stop_id, 1, 4)",
        stops_ids="stop_id",
        stops_names="stop_name",
    )
    names = lines.select(F.col("line_id").alias("l_line_id"), "line_name")
    joined = routes.join(names, routes["line_id"] == names["l_line_id"]).join(
        route_stops, F.col("route_id") == F.col("call_route_id"), "left"
    )
    dim = joined.select(
        surrogate_key("route_id", "l_line_id").alias("sk_routes"),
        "route_id",
        F.col("l_line_id").alias("line_id"),
        "route_name",
        "line_name",
        "list_municipality_name",
        "list_municipality_ids",
        "stops_ids",
        "stops_names",
    )
    return with_ingested_at(dim, now)


def dim_date(dates: DataFrame, calendar_dates: DataFrame, now: datetime | None = None) -> DataFrame:
    """Calendar days with their service attributes.

    A day on which services differ keeps one row per different combination. The
    service side is made distinct before the join, where one row per day and
    combination is left, rather than after it.
    """
    services = calendar_dates.select(
        F.col("date").alias("service_day"), "day_type", "exception_type", "holiday", "period_name"
    ).distinct()
    days = dates.distinct()
    joined = days.join(services, F.col("date_day") == F.col("service_day"), "left")
    return with_ingested_at(joined.drop("service_day"), now)


def dim_weather(weather_data: DataFrame, now: datetime | None = None) -> DataFrame:
    """Weather per day."""
    return with_ingested_at(
        weather_data.select(
            "date",
            "max_temperature",
            "min_temperature",
            "wind_speed_class",
            "precipitation_class",
            "weather_type",
        ),
        now,
    )


def _trip_date_lists(
    trips: DataFrame,
    calendar_dates: DataFrame,
    exception_types: Sequence[int] | None = None,
) -> DataFrame:
    """(trip_id, service_dates): the different days of each trip that runs, in one list.

    A list is no longer than the calendar, so a trip's days travel, and are joined, as one
    row. An unknown day is a NULL element.
    """
    if exception_types is not None:
        calendar_dates = calendar_dates.where(F.col("exception_type").isin(*exception_types))
    days = calendar_dates.groupBy(F.col("service_id").alias("cal_service_id")).agg(
        F.collect_set("date").alias("known"), F.max(F.col("date").isNull()).alias("unknown")
    )
    days = days.selectExpr(
        "cal_service_id", "if(unknown, array_append(known, cast(null as date)), known) as listed"
    )
    runs = trips.select(F.col("trip_id").alias("run_trip_id"), "service_id").distinct()
    return (
        runs.join(days, F.col("service_id") == F.col("cal_service_id"))
        .groupBy(F.col("run_trip_id").alias("trip_id"))
        .agg(F.array_distinct(F.flatten(F.collect_list("listed"))).alias("service_dates"))
    )


def trip_dates(
    trips: DataFrame,
    calendar_dates: DataFrame,
    exception_types: Sequence[int] | None = None,
) -> DataFrame:
    """The days on which each trip runs, each once.

    Days are listed per service and then per trip, where repeated trip versions and
    calendar rows fall together; only the finished lists become rows, in place.
    """
    return _trip_date_lists(trips, calendar_dates, exception_types).select(
        "trip_id", F.explode("service_dates").alias("service_date")
    )


def fact_trips(
    stop_times: DataFrame,
    trips: DataFrame,
    dim_routes: DataFrame,
    calendar_dates: DataFrame,
    latest_only: Sequence[str] | None = None,
    exception_types: Sequence[int] | None = None,
    listed: bool = False,
) -> DataFrame:
    """One row per trip, service date, route and direction.

    Duplicates are removed on the narrow trip attributes and trip dates, before
    they meet. Their combinations are then distinct by themselves, and the fact
    itself needs no final ``distinct``, which would shuffle the largest table.
    ``latest_only`` names version columns by which only the newest row of a trip
    is kept. With ``listed`` a trip's days stay together, as ``planned_dates`` (NULL for
    a trip without days); all rows of a trip have the same list.
    """
    if latest_only:
        trips = latest_per_key(trips, ["trip_id"], latest_only[0], latest_only[1:])
    keys = dim_routes.select(F.col("route_id").alias("dim_route_id"), "sk_routes")
    attributes = (
        trips.select("trip_id", "route_id", "direction_id")
        .distinct()
        .join(keys, F.col("route_id") == F.col("dim_route_id"), "left")
        .select(
            F.col("trip_id").alias("attr_trip_id"),
            "sk_routes",
            F.col("direction_id").alias("direction"),
        )
        .repartition("attr_trip_id")
        .distinct()
    )
    days = _trip_date_lists(trips, calendar_dates, exception_types).withColumnRenamed(
        "trip_id", "day_trip_id"
    )
    planned = stop_times.select(
        "trip_id",
        F.col("scheduled_start_time").alias("planned_start_time"),
        F.col("scheduled_end_time").alias("planned_end_time"),
        F.col("shape_dist_traveled").alias("total_distance_traveled"),
        "number_of_stops",
        gt.seconds_of(stop_times, "scheduled_start_s", "scheduled_start_time").alias(
            "planned_start_s"
        ),
        gt.seconds_of(stop_times, "scheduled_end_s", "scheduled_end_time").alias("planned_end_s"),
    )
    # worked out once per trip, before the trip is repeated for each of its days
    planned = planned.withColumn(
        "travel_minutes", gt.duration_minutes("planned_start_s", "planned_end_s")
    ).withColumn(
        "average_speed_kmh",
        F.expr("try_divide(total_distance_traveled * 0.001D, travel_minutes / 60)"),
    )
    joined = planned.join(attributes, F.col("trip_id") == F.col("attr_trip_id"), "left").join(
        days, F.col("trip_id") == F.col("day_trip_id"), "left"
    )
    return joined.select(
        "trip_id",
        "planned_start_time",
        "planned_end_time",
        F.col("service_dates").alias("planned_dates")
        if listed
        else F.explode_outer("service_dates").alias("planned_date"),
        "total_distance_traveled",
        "number_of_stops",
        "sk_routes",
        "average_speed_kmh",
        "direction",
        "planned_start_s",
        "planned_end_s",
        "travel_minutes",
    )


def dim_historical_trips(
    real_stop_times: DataFrame, fact_trips: DataFrame, now: datetime | None = None
) -> DataFrame:
    """Observed against planned times of a trip.

    ``accumulated_delay`` is in seconds: departure delay plus arrival delay, as
    clock times are subtracted. ``accumulated_delay_wrapped_s`` folds each of
    the two into plus or minus twelve hours, which is right across midnight.
    """
    planned = fact_trips.select(
        F.col("trip_id").alias("p_trip_id"),
        F.col("planned_date").alias("p_date"),
        gt.seconds_of(fact_trips, "planned_start_s", "planned_start_time").alias("p_start"),
        gt.seconds_of(fact_trips, "planned_end_s", "planned_end_time").alias("p_end"),
    )
    observed = real_stop_times.withColumns(
        {
            "r_start": gt.seconds_of(real_stop_times, "real_start_s", "real_start_time"),
            "r_end": gt.seconds_of(real_stop_times, "real_end_s", "real_end_time"),
        }
    )
    joined = observed.join(
        planned,
        (F.col("trip_id") == F.col("p_trip_id")) & (F.col("trip_date") == F.col("p_date")),
        "left",
    )
    dim = joined.select(
        "trip_id",
        "real_start_time",
        "real_end_time",
        "trip_date",
        flag_gt("r_start", "p_start").alias("departed_late"),
        flag_gt("r_end", "p_end").alias("arrived_late"),
        (gt.delay_seconds("r_start", "p_start") + gt.delay_seconds("r_end", "p_end")).alias(
            "accumulated_delay"
        ),
        (gt.wrapped_delay_seconds("r_start", "p_start") + gt.wrapped_delay_seconds("r_end", "p_end")).alias(
            "accumulated_delay_wrapped_s"
        ),
    )
    return with_ingested_at(dim, now)
