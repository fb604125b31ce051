"""Distance, speed and arrival estimates as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    double = lambda c: f"cast({c} as double)"
    half_sin = lambda a, b: f"sin(radians({double(b)} - {double(a)}) / 2)"
    cosine = lambda c: f"cos(radians({double(c)}))"
    chord = (
        f"power({half_sin(lat1, lat2)}, 2) + "
        f"{cosine(lat1)} * {cosine(lat2)} * power({half_sin(lon1, lon2)}, 2)"
    )
    # rounding may lift opposite points a hair above 1; a NULL must stay NULL,
    # which least() alone would not do
    chord = f"if(({chord}) is null, null, least({chord}, 1D))"
    return f"{2 * EARTH_RADIUS_KM}D * atan2(sqrt({chord}), sqrt(1D - {chord}))"


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance between two points in degrees; NULL in, NULL out."""
    return F.expr(_haversine(lat1, lon1, lat2, lon2))


def speed_kmh(km: str, seconds: str) -> Column:
    """Average speed; NULL when no time has passed."""
    return F.expr(f"try_divide({km}, ({seconds}) / 3600D)")


def eta_minutes(km: str, kmh: str) -> Column:
    """Minutes to cover ``km`` at ``kmh``; NULL for a standing vehicle."""
    return F.expr(f"try_divide({km}, {kmh}) * 60")


def elapsed_seconds(first: str, last: str) -> Column:
    """Whole seconds between two timestamps."""
    whole = lambda c: f"cast(cast({c} as timestamp) as bigint)"
    return F.expr(f"{whole(last)} - {whole(first)}")


def with_motion(df: DataFrame) -> DataFrame:
    """Add ``distance`` (km), ``time_delta`` (s) and ``average_speed`` (km/h)."""
    moved = df.withColumns(
        {
            "distance": haversine_km("first_lat", "first_lon", "last_lat", "last_lon"),
            "time_delta": elapsed_seconds("first_timestamp", "last_timestamp"),
        }
    )
    return moved.withColumn("average_speed", speed_kmh("distance", "time_delta"))


def register_functions(spark) -> None:
    """``haversine_km`` for SQL text, as a SQL function that is inlined into the plan."""
    body = _haversine("lat1", "lon1", "lat2", "lon2")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION haversine_km("
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) "
        f"RETURNS DOUBLE RETURN {body}"
    )
