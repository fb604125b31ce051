"""Declared checks of every relation."""

from __future__ import annotations

from transitlake.operators.quality import Check

# The accepted labels.
PERIOD_NAMES = ("Verão", "Férias Escolares", "Período Escolar", "Outros")
STOP_STATUSES = ("ACTIVE", "INACTIVE", "PROVISIONAL", "VOIDED", "SEASONAL")


def _not_null(columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns.split()]


def _unique(column: str) -> list[Check]:
    return [Check("unique", column)]


def _at_least_zero(columns: str) -> list[Check]:
    return [Check("minimum_value", c, 0) for c in columns.split()]


STAGING: dict[str, list[Check]] = {
    "stop_times": _not_null(
        "scheduled_start_time scheduled_end_time stop_sequence shape_dist_traveled trip_id"
    ),
    "real_stop_times": _not_null("trip_id real_start_time real_end_time"),
    "weather_data": _not_null("date wind_speed_class precipitation_class weather_type")
    + _unique("date"),
    "calendar_dates": _not_null(
        "date day_type exception_type holiday period_name service_id"
    )
    + [Check("accepted_values", "period_name", PERIOD_NAMES)],
    "routes": _not_null("route_id route_name line_id list_municipality_name")
    + _unique("route_id"),
    "lines": _not_null("line_id line_name list_routes list_patterns") + _unique("line_id"),
    "stops": _not_null(
        "stop_id stop_name municipality_id municipality_name region_name list_pattern "
        "operational_status"
    )
    + _unique("stop_id")
    + [Check("accepted_values", "operational_status", STOP_STATUSES)],
    "trips": _not_null("trip_id route_id pattern_id service_id shape_id"),
}

MARTS: dict[str, list[Check]] = {
    "fact_trips": _not_null(
        "trip_id planned_start_time planned_end_time planned_date total_distance_traveled "
        "number_of_stops sk_routes average_speed_kmh direction"
    )
    + _at_least_zero("total_distance_traveled number_of_stops average_speed_kmh"),
    "dim_routes": _not_null("route_id line_id route_name line_name list_municipality_name")
    + _unique("route_id"),
    "dim_historical_trips": _not_null(
        "trip_id real_start_time real_end_time trip_date departed_late arrived_late ingested_at"
    )
    + _unique("trip_id"),
    "dim_weather": _not_null(
        "date wind_speed_class precipitation_class weather_type ingested_at"
    )
    + _unique("date"),
}
