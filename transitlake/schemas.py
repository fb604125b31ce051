"""Explicit schemas of the feeds. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(text: str) -> T.StructType:
    """``"name type, ..."`` to a schema, without needing a session at import."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PING = _struct(
    "bearing float, block_id string, current_status string, id string, lat float, "
    "line_id string, lon float, pattern_id string, route_id string, "
    "schedule_relationship string, shift_id string, speed float, stop_id string, "
    "timestamp bigint, trip_id string"
)

STOP_LOCATION = _struct("stop_id string, stop_lat float, stop_lon float")

STOP_TIMES = _struct(
    "trip_id string, departure_time string, stop_sequence int, shape_dist_traveled double"
)
CALENDAR_DATES = _struct(
    "date int, day_type bigint, exception_type bigint, holiday bigint, period bigint, "
    "service_id string"
)
PERIODS = _struct("period_id bigint, period_name string")
TRIPS = _struct(
    "trip_id string, route_id string, pattern_id string, service_id string, "
    "shape_id string, direction_id bigint"
)
STOPS = _struct(
    "id string, stop_id string, name string, municipality_id string, "
    "municipality_name string, region_name string, operational_status string, "
    "patterns array<string>, routes array<string>, lat string, lon string"
)
LINES = _struct(
    "id string, long_name string, routes array<string>, patterns array<string>"
)
ROUTES = _struct(
    "id string, long_name string, line_id string, municipalities array<string>"
)
MUNICIPALITIES = _struct("id string, name string")
WEATHER_DATA = _struct(
    "dataPrevisao string, tMax string, tMin string, classIntVento bigint, "
    "classIntPrecipita bigint, idTipoTempo bigint, dataAtualiza string"
)
HISTORICAL_STOP_TIMES = _struct("trip_id string, timestamp timestamp")

# feed name -> (file kind, schema). The two tables that no query reads
# ("dates", "shapes") are loaded as they come and so have no schema here.
FEEDS: dict[str, tuple[str, T.StructType]] = {
    "stop_times": ("csv", STOP_TIMES),
    "calendar_dates": ("csv", CALENDAR_DATES),
    "periods": ("csv", PERIODS),
    "trips": ("csv", TRIPS),
    "stops": ("json", STOPS),
    "lines": ("json", LINES),
    "routes": ("json", ROUTES),
    "municipalities": ("json", MUNICIPALITIES),
    "weather_data": ("json", WEATHER_DATA),
}


def with_stamp(schema: T.StructType) -> T.StructType:
    """A raw table's schema: the feed's plus the load time."""
    return T.StructType([*schema.fields, T.StructField("ingested_at", T.TimestampType())])
