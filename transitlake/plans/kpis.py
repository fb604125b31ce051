"""The questions the marts answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.functions import gtfs_time as gt
from transitlake.operators.joins import unnest

GROUPINGS = ("plain", "rollup", "cube")


def _groupings(by: Sequence[str], grouping: str) -> list[tuple[int, list[str]]]:
    """(level, columns kept) of each grouping; a bit of the level stands for a column left out."""
    if grouping == "plain":
        kept = [list(by)]
    elif grouping == "rollup":
        kept = [list(by[:n]) for n in range(len(by), -1, -1)]
    else:
        kept = [
            [c for i, c in enumerate(by) if not mask >> (len(by) - 1 - i) & 1]
            for mask in range(1 << len(by))
        ]
    bit = {c: 1 << (len(by) - 1 - i) for i, c in enumerate(by)}
    return [(sum(bit[c] for c in by if c not in k), k) for k in kept]


def trip_kpis(
    fact: DataFrame,
    dim_routes: DataFrame,
    dim_date: DataFrame,
    by: Sequence[str],
    grouping: str = "plain",
) -> DataFrame:
    """Trips, kilometres, travel minutes and average speed by any dimension columns.

    A trip counts once per day and group, with its distance, minutes and speed, also
    where the day is unknown or the trip has several fact rows (one per version of
    its route). Each (group, trip, day) is first brought to one record, in a roll-up
    once for every level; this also spreads a large group over many tasks before its
    total is formed.

    A fact with ``planned_dates`` (see :func:`marts.fact_trips`) is brought to one
    record per (group, trip) with its days listed, and the days become rows after that:
    what is joined and shuffled is a row per trip, not one per trip and day.
    """
    if grouping not in GROUPINGS:
        raise ValueError(f"unknown grouping {grouping!r}")
    if "travel_minutes" in fact.columns:
        minutes = F.col("travel_minutes")
    else:
        fact = fact.withColumns(
            {
                "planned_start_s": gt.to_seconds("planned_start_time"),
                "planned_end_s": gt.to_seconds("planned_end_time"),
            }
        )
        minutes = gt.duration_minutes("planned_start_s", "planned_end_s")
    fact_columns = {*fact.columns} | {"planned_date"}
    route_columns = [c for c in by if c in dim_routes.columns and c not in fact_columns]
    date_columns = [
        c for c in by if c in dim_date.columns and c not in fact_columns and c not in route_columns
    ]
    by_trip = [c for c in by if c not in date_columns and c != "planned_date"]
    if route_columns:
        routes = dim_routes.select(F.col("sk_routes").alias("_sk"), *route_columns)
        fact = fact.join(routes, F.col("sk_routes") == F.col("_sk"), "left").drop("_sk")
    rows = fact.select(
        *by_trip,
        F.col("trip_id").alias("run_trip"),
        F.col("planned_dates" if "planned_dates" in fact.columns else "planned_date").alias("_days"),
        (F.col("total_distance_traveled") * 0.001).alias("km"),
        minutes.alias("minutes"),
        F.col("average_speed_kmh").alias("speed"),
    )
    if "planned_dates" not in fact.columns:
        rows = rows.withColumn("_days", F.array("_days"))
    if route_columns:
        # the join has placed rows by route; from here on they stay with their trip
        rows = rows.repartition("run_trip")
    # the levels as rows of structs: unlike grouping sets, they keep rows where they are
    levels = _groupings(by, grouping)
    if len(levels) > 1:
        masked = [
            F.struct(
                F.lit(level).alias("_level"),
                *[F.when(F.lit(c in kept), F.col(c)).alias(c) for c in by_trip],
            )
            for level, kept in levels
        ]
        rows = rows.select(
            F.explode(F.array(*masked)).alias("_at"), "run_trip", "_days", "km", "minutes", "speed"
        ).select("_at.*", "run_trip", "_days", "km", "minutes", "speed")
    else:
        rows = rows.withColumn("_level", F.lit(0))
    once = [F.max(c).alias(c) for c in ("km", "minutes", "speed")]
    runs = rows.groupBy("_level", *by_trip, "run_trip", "_days").agg(*once)
    runs = runs.withColumn("planned_date", F.explode_outer("_days")).drop("_days")
    if date_columns:
        # the dimension may hold several rows per day; a fact row must meet one. What is
        # left is a row per day of the calendar, at any size of the fact
        days = dim_date.select(F.col("date_day").alias("_day"), *date_columns)
        days = days.groupBy("_day").agg(*[F.min(c).alias(c) for c in date_columns])
        runs = runs.join(F.broadcast(days), F.col("planned_date") == F.col("_day"), "left")
    if len(levels) > 1:
        for c in by:
            if c not in by_trip:
                kept_at = [level for level, kept in levels if c in kept]
                runs = runs.withColumn(c, F.when(F.col("_level").isin(*kept_at), F.col(c)))
    return (
        runs.groupBy(*by, "_level")
        .agg(
            F.avg("speed").alias("average_speed_kmh"),
            F.count("run_trip").alias("number_of_trips"),
            F.sum("km").alias("km_travelled"),
            F.sum("minutes").alias("travel_minutes"),
        )
        .drop("_level")
    )


def routes_at_stop(stops: DataFrame, stop_id: str) -> DataFrame:
    """Routes that call at a stop, found by membership and not by text search."""
    there = stops.where(F.col("stop_id") == stop_id).select("routes")
    return unnest(there, "routes", "route_id").select("route_id").distinct()


def stop_route_pairs(stops: DataFrame) -> DataFrame:
    """Every (stop, route) pair once; the bridge behind :func:`routes_at_stop`."""
    return unnest(stops.select("stop_id", "routes"), "routes", "route_id").select(
        "stop_id", "route_id"
    ).distinct()


def routes_in_municipality(routes: DataFrame, municipality_id: str) -> DataFrame:
    """Routes that serve a municipality."""
    served = F.split("list_municipality_ids", ";")
    return (
        routes.where(F.array_contains(served, municipality_id)).select("route_id").distinct()
    )


def route_municipality_pairs(routes: DataFrame) -> DataFrame:
    """Every (route, municipality) pair once."""
    listed = routes.select(
        "route_id", F.explode(F.split("list_municipality_ids", ";")).alias("municipality_id")
    )
    return listed.distinct()
