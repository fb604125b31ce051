"""Staging, mart, view and key-figure queries over the derived feeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.functions.calendar import date_dimension_over
from transitlake.operators import quality
from transitlake.operators.dedupe import latest_per_key
from transitlake.plans import kpis, marts, staging, suites, views
from transitlake.sources.files import stop_locations
from transitlake.streaming.pings import vehicle_windows
from workloads import feeds
from workloads.feeds import FEED_SQL
from workloads.operator_queries import haversine_sql
from workloads.registry import query

LOADED_AT = datetime(2024, 1, 2)


# --- SQL building blocks ----------------------------------------------------


def clock_sql(text: str) -> str:
    hour = f"CAST(substr({text}, 1, 2) AS BIGINT)"
    return f"(lpad(CAST({hour} % 24 AS VARCHAR), 2, '0') || substr({text}, 3))"


def seconds_sql(clock: str) -> str:
    return (
        f"(CAST(substr({clock}, 1, 2) AS BIGINT) * 3600 + CAST(substr({clock}, 4, 2) AS BIGINT) * 60"
        f" + CAST(substr({clock}, 7, 2) AS BIGINT))"
    )


def label_sql(column: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE 'Unknown' END"


def _newest(source: str, key: str, version: str) -> str:
    return (
        f"SELECT * FROM {source} AS t WHERE {version} = "
        f"(SELECT max({version}) FROM {source} AS u WHERE u.{key} = t.{key})"
    )


def _windows_sql(slide: int) -> str:
    """Windows of two minutes with their motion, by the second they start in."""
    starts = ", ".join(f"ts // {slide} * {slide} - {back}" for back in range(0, 120, slide))
    return f"""SELECT *, {haversine_sql('first_lat', 'first_lon', 'last_lat', 'last_lon')} AS distance,
                   last_ts - first_ts AS time_delta
            FROM (SELECT id, trip_id, w, max(current_status) AS current_status,
                         max(route_id) AS route_id, max(stop_id) AS stop_id,
                         min(ts) AS first_ts, max(ts) AS last_ts,
                         arg_min(lat, (ts, lat, lon)) AS first_lat,
                         arg_min(lon, (ts, lat, lon)) AS first_lon,
                         arg_max(lat, (ts, lat, lon)) AS last_lat,
                         arg_max(lon, (ts, lat, lon)) AS last_lon
                  FROM (SELECT *, unnest([{starts}]) AS w FROM raw_pings)
                  GROUP BY id, trip_id, w)"""


# Each relation: the relations it needs, and its SQL.
RELATIONS: dict[str, tuple[str, str]] = {f"raw_{n}": ("", sql) for n, sql in FEED_SQL.items()}
RELATIONS |= {
    "stg_stop_times": (
        "raw_stop_times",
        f"""SELECT CASE WHEN n > 1 THEN {clock_sql('first_dep')} END AS scheduled_start_time,
                   {clock_sql('last_dep')} AS scheduled_end_time, seq AS stop_sequence,
                   dist AS shape_dist_traveled, trip_id, n AS number_of_stops
            FROM (SELECT trip_id, count(*) AS n, CAST(max(stop_sequence) AS BIGINT) AS seq,
                         arg_min(departure_time, (stop_sequence, departure_time)) AS first_dep,
                         arg_max(departure_time, (stop_sequence, departure_time)) AS last_dep,
                         arg_max(shape_dist_traveled, (stop_sequence, departure_time)) AS dist
                  FROM raw_stop_times GROUP BY trip_id)""",
    ),
    "stg_real_stop_times": (
        "raw_historical_stop_times",
        """SELECT trip_id, CAST(min(timestamp) AS DATE) AS trip_date,
                  strftime(min(timestamp), '%H:%M:00') AS real_start_time,
                  strftime(max(timestamp), '%H:%M:00') AS real_end_time
           FROM raw_historical_stop_times GROUP BY trip_id""",
    ),
    "stg_calendar_dates": (
        "raw_calendar_dates raw_periods",
        """SELECT CAST(strptime(CAST(date AS VARCHAR), '%Y%m%d') AS DATE) AS date, day_type,
                  exception_type, holiday, coalesce(period_name, 'Outros') AS period_name,
                  service_id
           FROM raw_calendar_dates LEFT JOIN raw_periods ON period = period_id""",
    ),
    "stg_routes": (
        "raw_routes raw_municipalities",
        f"""SELECT r.id AS route_id, long_name AS route_name, line_id,
                   string_agg(m.name, ';' ORDER BY m.id) AS list_municipality_name,
                   string_agg(m.id, ';' ORDER BY m.id) AS list_municipality_ids
            FROM ({_newest('raw_routes', 'id', 'ingested_at')}) AS r
            LEFT JOIN raw_municipalities AS m ON list_contains(r.municipalities, m.id)
            GROUP BY r.id, long_name, line_id""",
    ),
    "stg_lines": (
        "raw_lines",
        f"""SELECT id AS line_id, long_name AS line_name, routes AS list_routes,
                   patterns AS list_patterns
            FROM ({_newest('raw_lines', 'id', 'ingested_at')})""",
    ),
    "stg_stops": (
        "raw_stops",
        f"""SELECT stop_id, name AS stop_name, municipality_id, municipality_name, region_name,
                   patterns AS list_pattern, operational_status, routes
            FROM ({_newest('raw_stops', 'id', 'ingested_at')})""",
    ),
    "stg_trips": ("raw_trips", "SELECT * FROM raw_trips"),
    "stg_weather_data": (
        "raw_weather_data",
        f"""SELECT CAST(dataPrevisao AS DATE) AS date, TRY_CAST(tMax AS DOUBLE) AS max_temperature,
                   TRY_CAST(tMin AS DOUBLE) AS min_temperature,
                   {label_sql('classIntVento', staging.WIND_SPEED)} AS wind_speed_class,
                   {label_sql('classIntPrecipita', staging.PRECIPITATION)} AS precipitation_class,
                   {label_sql('idTipoTempo', staging.WEATHER_TYPE)} AS weather_type
            FROM ({_newest('raw_weather_data', 'dataPrevisao', 'dataAtualiza')})""",
    ),
    "dim_routes": (
        "stg_routes stg_lines stg_stops",
        """SELECT md5(r.route_id || '-' || l.line_id) AS sk_routes, r.route_id, l.line_id,
                  route_name, line_name, list_municipality_name, list_municipality_ids,
                  stops_ids, stops_names
           FROM stg_routes AS r JOIN stg_lines AS l ON r.line_id = l.line_id
           LEFT JOIN (SELECT route_id, string_agg(stop_id, ';' ORDER BY stop_id) AS stops_ids,
                             string_agg(stop_name, ';' ORDER BY stop_id) AS stops_names
                      FROM (SELECT stop_id, stop_name, unnest(routes) AS route_id FROM stg_stops)
                      GROUP BY route_id) AS c ON c.route_id = r.route_id""",
    ),
    "trip_dates": (
        "stg_trips stg_calendar_dates",
        """SELECT DISTINCT trip_id, date AS service_date
           FROM stg_trips AS t JOIN stg_calendar_dates AS c ON c.service_id = t.service_id""",
    ),
    "fact_trips": (
        "stg_stop_times stg_trips dim_routes trip_dates",
        f"""SELECT *, CASE WHEN minutes = 0 THEN NULL
                      ELSE total_distance_traveled * 0.001 / (minutes / 60.0) END
                        AS average_speed_kmh
            FROM (SELECT *, CASE WHEN b < a THEN 1440 - abs(b // 60 - a // 60)
                                 ELSE abs(b // 60 - a // 60) END AS minutes
                  FROM (SELECT DISTINCT st.trip_id, scheduled_start_time AS planned_start_time,
                               scheduled_end_time AS planned_end_time,
                               service_date AS planned_date,
                               shape_dist_traveled AS total_distance_traveled, number_of_stops,
                               sk_routes, direction_id AS direction,
                               {seconds_sql('scheduled_start_time')} AS a,
                               {seconds_sql('scheduled_end_time')} AS b
                        FROM stg_stop_times AS st
                        LEFT JOIN stg_trips AS t ON t.trip_id = st.trip_id
                        LEFT JOIN dim_routes AS dr ON dr.route_id = t.route_id
                        LEFT JOIN trip_dates AS td ON td.trip_id = st.trip_id))""",
    ),
    "dim_historical_trips": (
        "stg_real_stop_times fact_trips",
        f"""SELECT trip_id, real_start_time, real_end_time, trip_date,
                   coalesce(ra > a, FALSE) AS departed_late, coalesce(rb > b, FALSE) AS arrived_late,
                   (ra - a) + (rb - b) AS accumulated_delay
            FROM (SELECT r.*, {seconds_sql('real_start_time')} AS ra,
                         {seconds_sql('real_end_time')} AS rb, f.a, f.b
                  FROM stg_real_stop_times AS r LEFT JOIN fact_trips AS f
                    ON f.trip_id = r.trip_id AND f.planned_date = r.trip_date)""",
    ),
    "order_days": (
        "raw_calendar_dates",
        """SELECT CAST(unnest(generate_series(min(strptime(CAST(date AS VARCHAR), '%Y%m%d')),
                       max(strptime(CAST(date AS VARCHAR), '%Y%m%d')), INTERVAL 1 DAY)) AS DATE)
                    AS date_day FROM raw_calendar_dates""",
    ),
    "dim_date": (
        "order_days stg_calendar_dates",
        """SELECT DISTINCT date_day, strftime(date_day, '%B') AS month_name,
                  CAST(year(date_day) AS BIGINT) AS year_number, day_type, exception_type, holiday,
                  period_name
           FROM order_days LEFT JOIN stg_calendar_dates ON date_day = date""",
    ),
    "windows": ("raw_pings", _windows_sql(30)),
    "windows_10s": ("raw_pings", _windows_sql(10)),
}


def sql_of(rest: str, names: str) -> str:
    """``rest`` with the named relations, and what they need, in front of it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = RELATIONS[name]
        for other in needs.split():
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    ctes = ", ".join(f"{n} AS ({RELATIONS[n][1]})" for n in ordered)
    return f"WITH {ctes} {rest}"


def listed(df: DataFrame) -> DataFrame:
    """Without the integer twins of clock times."""
    return df.drop(*[c for c in df.columns if c.endswith("_s")])


# --- relations --------------------------------------------------------------


class Relations:
    """The models of one set of tables, built lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return feeds.FEEDS[name](self.spark, self.folder)

    def stop_times(self):
        return staging.stop_times(self.raw("stop_times"))

    def real_stop_times(self):
        return staging.real_stop_times(self.raw("historical_stop_times"))

    def calendar_dates(self):
        return staging.calendar_dates(self.raw("calendar_dates"), self.raw("periods"))

    def routes(self):
        return staging.routes(self.raw("routes"), self.raw("municipalities"))

    def lines(self):
        return staging.lines(self.raw("lines"))

    def stops(self):
        return staging.stops(self.raw("stops"))

    def trips(self):
        return staging.trips(self.raw("trips"))

    def weather_data(self):
        return staging.weather_data(self.raw("weather_data"))

    def dim_routes(self):
        return marts.dim_routes(self.routes(), self.lines(), self.stops(), LOADED_AT)

    def dim_weather(self):
        return marts.dim_weather(self.weather_data(), LOADED_AT)

    def dim_date(self):
        days = self.calendar_dates()
        return marts.dim_date(date_dimension_over(days, "date"), days, LOADED_AT)

    def fact_trips(self):
        return marts.fact_trips(
            self.stop_times(), self.trips(), self.dim_routes(), self.calendar_dates()
        )

    def dim_historical_trips(self):
        return marts.dim_historical_trips(self.real_stop_times(), self.fact_trips(), LOADED_AT)

    def windows(self):
        return vehicle_windows(self.raw("pings"))

    def stop_locations(self):
        # the newest version of each stop, so that a window meets one location
        return stop_locations(latest_per_key(self.raw("stops"), ["id"], "ingested_at"))


@query("stg_stop_times", sql_of("SELECT * FROM stg_stop_times", "stg_stop_times"))
def stg_stop_times(spark, folder):
    return listed(Relations(spark, folder).stop_times())


@query(
    "stg_real_stop_times",
    sql_of(
        "SELECT * REPLACE (CAST(trip_date AS VARCHAR) AS trip_date) FROM stg_real_stop_times",
        "stg_real_stop_times",
    ),
)
def stg_real_stop_times(spark, folder):
    return listed(Relations(spark, folder).real_stop_times())


@query(
    "stg_calendar_dates",
    sql_of(
        "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM stg_calendar_dates",
        "stg_calendar_dates",
    ),
)
def stg_calendar_dates(spark, folder):
    return Relations(spark, folder).calendar_dates()


@query("stg_routes", sql_of("SELECT * FROM stg_routes", "stg_routes"))
def stg_routes(spark, folder):
    return Relations(spark, folder).routes()


@query(
    "stg_lines",
    sql_of(
        """SELECT line_id, line_name, array_to_string(list_routes, ',') AS list_routes,
                  array_to_string(list_patterns, ',') AS list_patterns FROM stg_lines""",
        "stg_lines",
    ),
)
def stg_lines(spark, folder):
    return Relations(spark, folder).lines()


@query(
    "stg_stops",
    sql_of(
        """SELECT * REPLACE (array_to_string(list_pattern, ',') AS list_pattern,
                             array_to_string(routes, ',') AS routes) FROM stg_stops""",
        "stg_stops",
    ),
)
def stg_stops(spark, folder):
    return Relations(spark, folder).stops()


@query("stg_trips", sql_of("SELECT * FROM stg_trips", "stg_trips"))
def stg_trips(spark, folder):
    return Relations(spark, folder).trips()


_WEATHER = "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM stg_weather_data"


@query("stg_weather_data", sql_of(_WEATHER, "stg_weather_data"))
def stg_weather_data(spark, folder):
    return Relations(spark, folder).weather_data()


_STAMP = "'2024-01-02 00:00:00' AS ingested_at"


@query("dim_weather", sql_of(f"SELECT *, {_STAMP} FROM ({_WEATHER})", "stg_weather_data"))
def dim_weather(spark, folder):
    return Relations(spark, folder).dim_weather()


@query("dim_routes", sql_of(f"SELECT *, {_STAMP} FROM dim_routes", "dim_routes"))
def dim_routes(spark, folder):
    return Relations(spark, folder).dim_routes()


@query(
    "dim_date",
    sql_of(
        f"SELECT * REPLACE (CAST(date_day AS VARCHAR) AS date_day), {_STAMP} FROM dim_date",
        "dim_date",
    ),
)
def dim_date(spark, folder):
    return (
        Relations(spark, folder)
        .dim_date()
        .select(
            "date_day",
            "month_name",
            "year_number",
            "day_type",
            "exception_type",
            "holiday",
            "period_name",
            "ingested_at",
        )
    )


@query(
    "service_days",
    sql_of("SELECT trip_id, CAST(service_date AS VARCHAR) AS service_date FROM trip_dates",
           "trip_dates"),
)
def service_days(spark, folder):
    r = Relations(spark, folder)
    return marts.trip_dates(r.trips(), r.calendar_dates())


@query(
    "fact_trips",
    sql_of(
        """SELECT trip_id, planned_start_time, planned_end_time,
                  CAST(planned_date AS VARCHAR) AS planned_date, total_distance_traveled,
                  number_of_stops, sk_routes, round(average_speed_kmh, 6) AS average_speed_kmh,
                  direction FROM fact_trips""",
        "fact_trips",
    ),
)
def fact_trips(spark, folder):
    return listed(Relations(spark, folder).fact_trips()).drop("travel_minutes")


@query(
    "dim_historical_trips",
    sql_of(
        f"""SELECT * REPLACE (CAST(trip_date AS VARCHAR) AS trip_date), {_STAMP}
            FROM dim_historical_trips""",
        "dim_historical_trips",
    ),
)
def dim_historical_trips(spark, folder):
    return Relations(spark, folder).dim_historical_trips().drop("accumulated_delay_wrapped_s")


# --- key figures ------------------------------------------------------------

_KPI_AGGREGATES = """round(avg(speed), 6) AS average_speed_kmh,
    count(trip_id) AS number_of_trips,
    round(sum(km), 6) AS km_travelled,
    CAST(sum(minutes) AS BIGINT) AS travel_minutes"""

# one record per trip and day in a group, whatever the trip's fact rows
_KPI_ONCE = """f.trip_id, planned_date AS day, max(average_speed_kmh) AS speed,
    max(total_distance_traveled * 0.001) AS km, max(minutes) AS minutes"""


def _kpis(spark, folder, by, grouping="plain"):
    r = Relations(spark, folder)
    routes = r.dim_routes()
    fact = marts.fact_trips(
        r.stop_times(), r.trips(), routes, r.calendar_dates(), listed=True
    )
    return kpis.trip_kpis(fact, routes, r.dim_date(), by, grouping)


@query(
    "trip_kpis_by_line_direction",
    sql_of(
        f"""SELECT line_id, direction, {_KPI_AGGREGATES}
            FROM (SELECT line_id, direction, {_KPI_ONCE} FROM fact_trips AS f
                  LEFT JOIN dim_routes AS d ON d.sk_routes = f.sk_routes GROUP BY ALL)
            GROUP BY ALL""",
        "fact_trips",
    ),
)
def trip_kpis_by_line_direction(spark, folder):
    return _kpis(spark, folder, ["line_id", "direction"])


@query(
    "trip_kpis_by_date",
    sql_of(
        f"""SELECT CAST(day AS VARCHAR) AS planned_date, {_KPI_AGGREGATES}
            FROM (SELECT {_KPI_ONCE} FROM fact_trips AS f GROUP BY ALL) GROUP BY ALL""",
        "fact_trips",
    ),
)
def trip_kpis_by_date(spark, folder):
    return _kpis(spark, folder, ["planned_date"])


@query(
    "trip_kpis_by_route",
    sql_of(
        f"""SELECT route_id, {_KPI_AGGREGATES}
            FROM (SELECT route_id, {_KPI_ONCE} FROM fact_trips AS f
                  LEFT JOIN dim_routes AS d ON d.sk_routes = f.sk_routes GROUP BY ALL)
            GROUP BY ALL""",
        "fact_trips",
    ),
)
def trip_kpis_by_route(spark, folder):
    return _kpis(spark, folder, ["route_id"])


@query(
    "trip_kpis_rollup",
    sql_of(
        f"""SELECT period_name, line_id, {_KPI_AGGREGATES}
            FROM (SELECT period_name, line_id, grouping_id(period_name, line_id) AS level,
                         {_KPI_ONCE} FROM fact_trips AS f
                  LEFT JOIN dim_routes AS d ON d.sk_routes = f.sk_routes
                  LEFT JOIN (SELECT date_day, min(period_name) AS period_name
                             FROM dim_date GROUP BY 1) ON date_day = planned_date
                  GROUP BY f.trip_id, planned_date, ROLLUP (period_name, line_id))
            GROUP BY period_name, line_id, level""",
        "fact_trips dim_date",
    ),
)
def trip_kpis_rollup(spark, folder):
    return _kpis(spark, folder, ["period_name", "line_id"], "rollup")


@query(
    "routes_at_stop",
    sql_of(
        "SELECT DISTINCT unnest(routes) AS route_id FROM stg_stops WHERE stop_id = '000007'",
        "stg_stops",
    ),
)
def routes_at_stop(spark, folder):
    return kpis.routes_at_stop(Relations(spark, folder).stops(), "000007")


@query(
    "stop_route_pairs",
    sql_of("SELECT DISTINCT stop_id, unnest(routes) AS route_id FROM stg_stops", "stg_stops"),
)
def stop_route_pairs(spark, folder):
    return kpis.stop_route_pairs(Relations(spark, folder).stops())


@query(
    "routes_in_municipality",
    sql_of(
        """SELECT DISTINCT id AS route_id FROM raw_routes AS r
           WHERE ingested_at = (SELECT max(ingested_at) FROM raw_routes AS u WHERE u.id = r.id)
             AND list_contains(municipalities, '3')""",
        "raw_routes",
    ),
)
def routes_in_municipality(spark, folder):
    return kpis.routes_in_municipality(Relations(spark, folder).routes(), "3")


@query(
    "route_municipality_pairs",
    sql_of(
        """SELECT DISTINCT route_id,
                  unnest(string_split(list_municipality_ids, ';')) AS municipality_id
           FROM stg_routes WHERE list_municipality_ids IS NOT NULL""",
        "stg_routes",
    ),
)
def route_municipality_pairs(spark, folder):
    return kpis.route_municipality_pairs(Relations(spark, folder).routes())


# --- positions --------------------------------------------------------------

_WINDOW_COLUMNS = """id, trip_id, w AS window_start, current_status, route_id, stop_id,
    first_ts, last_ts, round(CAST(first_lat AS DOUBLE), 6) AS first_lat,
    round(CAST(first_lon AS DOUBLE), 6) AS first_lon, round(CAST(last_lat AS DOUBLE), 6) AS last_lat,
    round(CAST(last_lon AS DOUBLE), 6) AS last_lon, round(distance, 6) AS distance, time_delta,
    round(distance / nullif(time_delta / 3600.0, 0), 6) AS average_speed"""


def window_columns(df: DataFrame) -> DataFrame:
    """Windows in plain types."""
    return df.select(
        "id",
        "trip_id",
        F.unix_seconds("window.start").alias("window_start"),
        "current_status",
        "route_id",
        "stop_id",
        F.unix_seconds("first_timestamp").alias("first_ts"),
        F.unix_seconds("last_timestamp").alias("last_ts"),
        *[
            F.round(F.col(c).cast("double"), 6).alias(c)
            for c in ("first_lat", "first_lon", "last_lat", "last_lon")
        ],
        F.round("distance", 6).alias("distance"),
        "time_delta",
        F.round("average_speed", 6).alias("average_speed"),
    )


@query("motion_windows", sql_of(f"SELECT {_WINDOW_COLUMNS} FROM windows", "windows"))
def motion_windows(spark, folder):
    return window_columns(Relations(spark, folder).windows())


@query("motion_windows_10s", sql_of(f"SELECT {_WINDOW_COLUMNS} FROM windows_10s", "windows_10s"))
def motion_windows_10s(spark, folder):
    """The same with a window every ten seconds, put together from panes of ten seconds."""
    pings = Relations(spark, folder).raw("pings")
    return window_columns(vehicle_windows(pings, slide="10 seconds"))


_ETA = f"""SELECT id, w AS window_start, stop_id, round(km, 4) AS distance_till_stop,
                  round(km / nullif(distance / nullif(time_delta / 3600.0, 0), 0) * 60, 3)
                    AS stop_eta
           FROM (SELECT v.*, {haversine_sql('last_lat', 'last_lon', 's_lat', 's_lon')} AS km
                 FROM ({{source}}) AS v
                 LEFT JOIN (SELECT stop_id AS s_id, CAST(lat AS FLOAT) AS s_lat,
                                   CAST(lon AS FLOAT) AS s_lon
                            FROM raw_stops WHERE ingested_at = TIMESTAMP '2024-01-02')
                   ON s_id = stop_id)"""


def eta_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        F.unix_seconds("window.start").alias("window_start"),
        "stop_id",
        F.round("distance_till_stop", 4).alias("distance_till_stop"),
        F.round("stop_eta", 3).alias("stop_eta"),
    )


@query(
    "live_vehicles",
    sql_of(
        _ETA.format(
            source="SELECT * FROM windows WHERE last_ts > (SELECT max(last_ts) FROM windows) - 120"
        ),
        "windows raw_stops",
    ),
)
def live_vehicles(spark, folder):
    r = Relations(spark, folder)
    return eta_columns(views.live_vehicles(r.windows(), r.stop_locations()))


@query(
    "latest_vehicles",
    sql_of(
        _ETA.format(
            source="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id
                        ORDER BY last_ts DESC, w DESC, trip_id DESC) AS n FROM windows)
                      WHERE n = 1"""
        ),
        "windows raw_stops",
    ),
)
def latest_vehicles(spark, folder):
    r = Relations(spark, folder)
    return eta_columns(views.latest_vehicles(r.windows(), r.stop_locations()))


# --- declared checks --------------------------------------------------------


def _suite_sql(relation: str, checks) -> str:
    parts = []
    for c in checks:
        column = f'"{c.column}"'
        if c.kind == "not_null":
            count = f"SELECT count(*) FROM {relation} WHERE {column} IS NULL"
        elif c.kind == "minimum_value":
            count = f"SELECT count(*) FROM {relation} WHERE {column} < {c.argument}"
        elif c.kind == "unique":
            count = (
                f"SELECT count(*) FROM (SELECT {column} FROM {relation} WHERE {column} IS NOT NULL "
                f"GROUP BY 1 HAVING count(*) > 1)"
            )
        else:
            listed = ", ".join(f"'{v}'" for v in c.argument)
            count = (
                f"SELECT count(DISTINCT {column}) FROM {relation} WHERE {column} NOT IN ({listed})"
            )
        parts.append(
            f"""SELECT '{c.kind}' AS "check", '{c.column}' AS "column", ({count}) AS failures"""
        )
    return " UNION ALL ".join(parts)


def _register_suites() -> None:
    stamped = f"(SELECT *, {_STAMP} FROM {{}})"
    for name, checks in suites.STAGING.items():
        relation = f"stg_{name}"
        _register_suite(f"checks_{relation}", name, checks, relation, relation)
    for name, checks in suites.MARTS.items():
        relation = "stg_weather_data" if name == "dim_weather" else name
        source = relation if name == "fact_trips" else stamped.format(relation)
        _register_suite(f"checks_{name}", name, checks, relation, source)


def _register_suite(query_name, method, checks, relation, source) -> None:
    def run(spark, folder):
        return quality.run_suite(getattr(Relations(spark, folder), method)(), checks)

    query(query_name, sql_of(_suite_sql(source, checks), relation))(run)


_register_suites()
