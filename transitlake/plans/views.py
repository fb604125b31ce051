"""Views over the windows written by the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.functions.geo import elapsed_seconds, eta_minutes, haversine_km, speed_kmh
from transitlake.operators.dedupe import latest_per_key
from transitlake.operators.filters import recent_slice

LIVE_SECONDS = 120


def with_next_stop(windows: DataFrame, stops: DataFrame) -> DataFrame:
    """Add the location of the stop a vehicle is heading for.

    ``windows`` may be a stream. The stop table is broadcast when Spark measures
    it below its threshold.
    """
    return windows.join(stops.select("stop_id", "stop_lat", "stop_lon"), "stop_id", "left")


def with_eta(windows: DataFrame, stops: DataFrame) -> DataFrame:
    """Add ``distance_till_stop`` (km), speed (km/h) and ``stop_eta`` (minutes)."""
    near = with_next_stop(windows, stops)
    measured = near.withColumns(
        {
            "distance_till_stop": haversine_km("last_lat", "last_lon", "stop_lat", "stop_lon"),
            "time_delta": elapsed_seconds("first_timestamp", "last_timestamp"),
        }
    )
    moving = measured.withColumn("average_speed", speed_kmh("distance", "time_delta"))
    return moving.withColumn("stop_eta", eta_minutes("distance_till_stop", "average_speed"))


def live_vehicles(windows: DataFrame, stops: DataFrame, seconds: int = LIVE_SECONDS) -> DataFrame:
    """Windows of the last two minutes with the time to the next stop.

    A vehicle may appear with several windows.
    """
    return with_eta(recent_slice(windows, "last_timestamp", seconds), stops)


def latest_vehicles(windows: DataFrame, stops: DataFrame) -> DataFrame:
    """The newest window of every vehicle with the time to the next stop."""
    newest = latest_per_key(
        windows, ["id"], "last_timestamp", [F.col("window.end"), "trip_id"]
    )
    return with_eta(newest, stops)
