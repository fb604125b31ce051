"""Transit feeds derived from the driver's tables, row for row.

The schedule, reference, weather and position feeds the models read are formed
here from orders, lineitem, customer, supplier, nation, region and events, so
the models run on inputs that grow with those tables. ``FEED_SQL`` states the
same derivations for the SQL check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Schemas of the given tables: reading with them opens no footer up front.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{name}.parquet"
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)


def _versions(df: DataFrame) -> DataFrame:
    """Two loads of each row, a day apart."""
    two = df.withColumn("ver", F.explode(F.array(F.lit(0), F.lit(1))))
    return two.withColumn(
        "ingested_at", F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(ver)")
    )


def municipalities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "cast(n_nationkey as string) as id",
        "n_name as name",
        "timestamp'2024-01-01 00:00:00' as ingested_at",
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return _versions(table(spark, folder, "nation")).selectExpr(
        "cast(n_nationkey as string) as id",
        "concat('Line ', n_name, ' v', ver) as long_name",
        "array(concat('R', n_nationkey), concat('R', n_nationkey + ver)) as routes",
        "array(concat('P', n_regionkey)) as patterns",
        "ingested_at",
    )


def routes(spark: SparkSession, folder: str) -> DataFrame:
    return _versions(table(spark, folder, "customer")).selectExpr(
        "cast(c_custkey as string) as id",
        "concat(c_name, ' v', ver) as long_name",
        # customers in debt belong to a line that does not exist
        "cast(if(c_acctbal < 0, c_nationkey + 100, c_nationkey) as string) as line_id",
        """case when c_mktsegment = 'FURNITURE' then null
                when c_mktsegment = 'MACHINERY' then cast(array() as array<string>)
                else array(cast(c_nationkey as string),
                           cast((c_nationkey + 7 + ver) % 25 as string),
                           null, '999',
                           cast(c_nationkey as string)) end as municipalities""",
        "ingested_at",
    )


def stops(spark: SparkSession, folder: str) -> DataFrame:
    return _versions(table(spark, folder, "supplier")).selectExpr(
        "cast(s_suppkey as string) as id",
        "lpad(cast(s_suppkey as string), 6, '0') as stop_id",
        "concat(s_name, ' v', ver) as name",
        "cast(s_nationkey as string) as municipality_id",
        "concat('NATION_', s_nationkey) as municipality_name",
        "concat('REGION_', s_nationkey % 5) as region_name",
        "if(s_acctbal < 0, 'VOIDED', 'ACTIVE') as operational_status",
        "array(concat('P', s_nationkey)) as patterns",
        """case when s_acctbal < -500 then null
                else transform(sequence(0, 9), i ->
                     cast((s_suppkey * 37 + i * 11 + ver) % 1009 as string)) end as routes""",
        "cast(38.6e0 + s_suppkey * 0.0003e0 as string) as lat",
        "cast(-9.3e0 + s_nationkey * 0.01e0 as string) as lon",
        "ingested_at",
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    # pending orders come with a second version that names another route
    orders = table(spark, folder, "orders").withColumn(
        "ver",
        F.explode(F.expr("if(o_orderstatus = 'P', array(0, 1), array(0))")),
    )
    return orders.selectExpr(
        "cast(o_orderkey as string) as trip_id",
        "cast(o_custkey + ver as string) as route_id",
        "concat(o_custkey, '_', ver) as pattern_id",
        "concat('S', o_custkey) as service_id",
        "concat('H', o_custkey) as shape_id",
        "cast(o_orderkey % 2 as bigint) as direction_id",
    )


def calendar_dates(spark: SparkSession, folder: str) -> DataFrame:
    # a service runs on every day its customer ordered
    orders = table(spark, folder, "orders")
    days = orders.select("o_custkey", F.to_date("o_orderdate").alias("day")).distinct()
    return days.selectExpr(
        "cast(date_format(day, 'yyyyMMdd') as int) as date",
        "cast(if(dayofweek(day) in (1, 7), 2, 1) as bigint) as day_type",
        "cast(1 as bigint) as exception_type",
        "cast(if(month(day) = 12, 1, 0) as bigint) as holiday",
        "cast(month(day) as bigint) as period",
        "concat('S', o_custkey) as service_id",
    )


def periods(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").selectExpr(
        "cast(r_regionkey + 1 as bigint) as period_id", "r_name as period_name"
    )


def stop_times(spark: SparkSession, folder: str) -> DataFrame:
    # the distance follows from sequence and departure, as it does on a real route
    return table(spark, folder, "lineitem").selectExpr(
        "cast(l_orderkey as string) as trip_id",
        """concat(lpad(cast(4 + l_linenumber * 3 + l_partkey % 3 as string), 2, '0'), ':',
                  lpad(cast(l_suppkey % 60 as string), 2, '0'), ':',
                  lpad(cast(l_partkey % 60 as string), 2, '0')) as departure_time""",
        "l_linenumber as stop_sequence",
        """cast(l_linenumber * 4000 + (l_partkey % 3) * 1000 + (l_suppkey % 60) * 10
                + l_partkey % 60 as double) as shape_dist_traveled""",
    )


def historical_stop_times(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.selectExpr(
        "cast(l_orderkey as string) as trip_id",
        """cast(o_orderdate as timestamp)
             + make_dt_interval(0, cast(l_linenumber * 3 as int), cast(l_suppkey % 60 as int),
                                cast(l_partkey % 7200 as decimal(18, 6))) as timestamp""",
    )


def weather_data(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM-dd') as dataPrevisao",
        "cast(o_custkey % 40 as string) as tMax",
        "if(o_orderstatus = 'P', 'n/a', cast(o_custkey % 20 as string)) as tMin",
        "cast(o_orderkey % 6 as bigint) as classIntVento",
        "cast(o_custkey % 5 as bigint) as classIntPrecipita",
        "cast(if(o_orderstatus = 'F', null, o_orderkey % 33) as bigint) as idTipoTempo",
        "lpad(cast(o_orderkey as string), 15, '0') as dataAtualiza",
    )


def pings(spark: SparkSession, folder: str) -> DataFrame:
    """A position every three seconds; each user is a vehicle."""
    return table(spark, folder, "events").selectExpr(
        "cast(0 as float) as bearing",
        "cast(null as string) as block_id",
        "event_type as current_status",
        "cast(user_id as string) as id",
        "cast(38.6e0 + (event_id % 1000) * 0.0004e0 as float) as lat",
        "cast(null as string) as line_id",
        "cast(-9.3e0 + (user_id % 40) * 0.005e0 as float) as lon",
        "cast(null as string) as pattern_id",
        "concat('R', user_id % 10) as route_id",
        "'SCHEDULED' as schedule_relationship",
        "cast(null as string) as shift_id",
        "cast(value as float) as speed",
        "lpad(cast(user_id % 25 as string), 6, '0') as stop_id",
        "1704067200 + event_id * 3 as timestamp",
        "concat(user_id, '-', cast(floor(event_id / 2000) as bigint)) as trip_id",
    )


FEEDS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "municipalities": municipalities,
    "lines": lines,
    "routes": routes,
    "stops": stops,
    "trips": trips,
    "calendar_dates": calendar_dates,
    "periods": periods,
    "stop_times": stop_times,
    "historical_stop_times": historical_stop_times,
    "weather_data": weather_data,
    "pings": pings,
}


def _two_loads(name: str) -> str:
    return (
        f"(SELECT *, TIMESTAMP '2024-01-01' + to_days(ver) AS ingested_at "
        f"FROM (SELECT *, unnest([0, 1]) AS ver FROM {name}))"
    )


FEED_SQL: dict[str, str] = {
    "municipalities": """
        SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation""",
    "lines": f"""
        SELECT CAST(n_nationkey AS VARCHAR) AS id,
               'Line ' || n_name || ' v' || ver AS long_name,
               ['R' || n_nationkey, 'R' || (n_nationkey + ver)] AS routes,
               ['P' || n_regionkey] AS patterns, ingested_at
        FROM {_two_loads('nation')}""",
    "routes": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' v' || ver AS long_name,
               CAST(CASE WHEN c_acctbal < 0 THEN c_nationkey + 100 ELSE c_nationkey END
                    AS VARCHAR) AS line_id,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
                    WHEN c_mktsegment = 'MACHINERY' THEN CAST([] AS VARCHAR[])
                    ELSE [CAST(c_nationkey AS VARCHAR),
                          CAST((c_nationkey + 7 + ver) % 25 AS VARCHAR), NULL, '999',
                          CAST(c_nationkey AS VARCHAR)] END AS municipalities,
               ingested_at
        FROM {_two_loads('customer')}""",
    "stops": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS id,
               lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS stop_id,
               s_name || ' v' || ver AS name, CAST(s_nationkey AS VARCHAR) AS municipality_id,
               'NATION_' || s_nationkey AS municipality_name,
               'REGION_' || (s_nationkey % 5) AS region_name,
               CASE WHEN s_acctbal < 0 THEN 'VOIDED' ELSE 'ACTIVE' END AS operational_status,
               ['P' || s_nationkey] AS patterns,
               CASE WHEN s_acctbal < -500 THEN NULL
                    ELSE list_transform(range(0, 10), lambda i:
                         CAST((s_suppkey * 37 + i * 11 + ver) % 1009 AS VARCHAR)) END AS routes,
               38.6e0 + s_suppkey * 0.0003e0 AS lat, -9.3e0 + s_nationkey * 0.01e0 AS lon,
               ingested_at
        FROM {_two_loads('supplier')}""",
    "trips": """
        SELECT CAST(o_orderkey AS VARCHAR) AS trip_id,
               CAST(o_custkey + ver AS VARCHAR) AS route_id,
               o_custkey || '_' || ver AS pattern_id, 'S' || o_custkey AS service_id,
               'H' || o_custkey AS shape_id, CAST(o_orderkey % 2 AS BIGINT) AS direction_id
        FROM orders JOIN (VALUES (0), (1)) AS v(ver) ON ver = 0 OR o_orderstatus = 'P'""",
    "calendar_dates": """
        SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date,
               CAST(CASE WHEN dayofweek(day) IN (0, 6) THEN 2 ELSE 1 END AS BIGINT) AS day_type,
               CAST(1 AS BIGINT) AS exception_type,
               CAST(CASE WHEN month(day) = 12 THEN 1 ELSE 0 END AS BIGINT) AS holiday,
               CAST(month(day) AS BIGINT) AS period, 'S' || o_custkey AS service_id
        FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "periods": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS period_id, r_name AS period_name FROM region""",
    "stop_times": """
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
               lpad(CAST(4 + l_linenumber * 3 + l_partkey % 3 AS VARCHAR), 2, '0') || ':' ||
               lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0') || ':' ||
               lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') AS departure_time,
               l_linenumber AS stop_sequence,
               CAST(l_linenumber * 4000 + (l_partkey % 3) * 1000 + (l_suppkey % 60) * 10
                    + l_partkey % 60 AS DOUBLE) AS shape_dist_traveled
        FROM lineitem""",
    "historical_stop_times": """
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
               o_orderdate + to_hours(l_linenumber * 3) + to_minutes(l_suppkey % 60)
                 + to_seconds(l_partkey % 7200) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "weather_data": """
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS dataPrevisao,
               CAST(o_custkey % 40 AS VARCHAR) AS tMax,
               CASE WHEN o_orderstatus = 'P' THEN 'n/a'
                    ELSE CAST(o_custkey % 20 AS VARCHAR) END AS tMin,
               o_orderkey % 6 AS classIntVento, o_custkey % 5 AS classIntPrecipita,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey % 33 END AS idTipoTempo,
               lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS dataAtualiza
        FROM orders""",
    "pings": """
        SELECT event_type AS current_status, CAST(user_id AS VARCHAR) AS id,
               CAST(38.6e0 + (event_id % 1000) * 0.0004e0 AS FLOAT) AS lat,
               CAST(-9.3e0 + (user_id % 40) * 0.005e0 AS FLOAT) AS lon,
               'R' || (user_id % 10) AS route_id,
               lpad(CAST(user_id % 25 AS VARCHAR), 6, '0') AS stop_id,
               1704067200 + event_id * 3 AS ts,
               user_id || '-' || (event_id // 2000) AS trip_id
        FROM events""",
}


def with_feeds(names: str, rest: str) -> str:
    """SQL text with the named feeds as ``raw_*`` subqueries in front of ``rest``."""
    ctes = ", ".join(f"raw_{n} AS ({FEED_SQL[n]})" for n in names.split())
    return f"WITH {ctes} {rest}"
