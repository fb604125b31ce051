"""Round trips through files, archives, tables and a stream.

Each query writes what it needs below the shared folder of the session, derived
from the given tables, and reads it back with the library's readers.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake import schemas
from transitlake.operators.incremental import load_table
from transitlake.plans import views
from transitlake.session import shared_folder
from transitlake.sources.archives import arrow_uri, zip_member_table
from transitlake.sources.files import (
    project_to,
    read_csv_feed,
    read_enveloped_json,
    read_json_array,
    stop_locations,
)
from transitlake.sources.landing import read_landing, write_landing_partitioned
from transitlake.sources.lost_cells import land
from transitlake.sources.tables import full_refresh
from transitlake.streaming.pings import (
    dropped_rows,
    read_pings,
    vehicle_windows,
    work_off,
    write_windows,
)
from transitlake.streaming.sink import read_windows, recent_windows
from workloads import feeds
from workloads.feeds import FEED_SQL, table, with_feeds
from workloads.model_queries import (
    _ETA,
    _WINDOW_COLUMNS,
    Relations,
    eta_columns,
    sql_of,
    window_columns,
)
from workloads.registry import query

TS = "'%Y-%m-%d %H:%M:%S'"
RECORDS_PER_DOCUMENT = 5_000


def _closed_sql(windows: str) -> str:
    return sql_of(
        f"""SELECT {_WINDOW_COLUMNS} FROM {windows}
            WHERE w + 120 <= (SELECT max(ts) FROM raw_pings) - 180""",
        f"{windows} raw_pings",
    )


def _worked_off(spark: SparkSession, base: str, slide: str) -> T.StructType:
    """Run the job over the pings below ``base`` until none is left."""
    windows = vehicle_windows(read_pings(spark, f"{base}/in"), slide=slide)
    # waits for the end however long it takes; a failure of the stream is raised
    work_off(write_windows(windows, f"{base}/out", f"{base}/checkpoint", trigger=None))
    return windows.schema


def _streamed(spark: SparkSession, folder: str, slide: str) -> DataFrame:
    base = shared_folder(spark, "stream-windows")
    feeds.pings(spark, folder).write.json(f"{base}/in")
    schema = _worked_off(spark, base, slide)
    return window_columns(read_windows(spark, f"{base}/out", schema))


@query("stream_windows", _closed_sql("windows"))
def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming job over JSON pings, worked off in one go.

    With a single micro-batch no row is late, so what is written is every window
    that ends no later than the final watermark, whatever the order of the files.
    A long history is better served by the batch form, ``motion_windows``, which
    keeps no state.
    """
    return _streamed(spark, folder, "30 seconds")


@query("stream_windows_10s", _closed_sql("windows_10s"))
def stream_windows_10s(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming job with a window every ten seconds."""
    return _streamed(spark, folder, "10 seconds")


@query(
    "stream_late_rows",
    sql_of(
        """SELECT id, trip_id, w AS window_start, first_ts, last_ts,
                  (SELECT count(*) FROM (SELECT DISTINCT id, trip_id, ts // 30 FROM (
                     SELECT id, trip_id, 2 * (SELECT min(ts) FROM raw_pings) - 3600 - ts AS ts
                     FROM raw_pings))) AS late_rows
           FROM windows WHERE w + 120 <= (SELECT max(ts) FROM raw_pings) - 180""",
        "windows raw_pings",
    ),
)
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Pings of the time before the first arrive when the rest has been worked off.

    All of them are late and change no window; the ledger counts what was dropped, a row
    per vehicle, trip and pane.
    """
    base = shared_folder(spark, "stream-late")
    pings = feeds.pings(spark, folder)
    pings.write.json(f"{base}/in")
    schema = _worked_off(spark, base, "30 seconds")
    start = pings.agg(F.min("timestamp").alias("start"))
    late = pings.crossJoin(F.broadcast(start)).withColumn(
        "timestamp", 2 * F.col("start") - 3600 - F.col("timestamp")
    )
    late.drop("start").write.mode("append").json(f"{base}/in")
    windows = vehicle_windows(read_pings(spark, f"{base}/in"))
    query = write_windows(windows, f"{base}/out", f"{base}/checkpoint", trigger=None)
    query.awaitTermination()
    return read_windows(spark, f"{base}/out", schema).select(
        "id",
        "trip_id",
        F.unix_seconds("window.start").alias("window_start"),
        F.unix_seconds("first_timestamp").alias("first_ts"),
        F.unix_seconds("last_timestamp").alias("last_ts"),
        F.lit(dropped_rows(query)).cast("bigint").alias("late_rows"),
    )


@query(
    "live_vehicles_of_sink",
    sql_of(
        _ETA.format(
            source="""SELECT * FROM windows
                      WHERE w + 120 <= (SELECT max(ts) FROM raw_pings) - 180
                        AND last_ts > (SELECT max(last_ts) FROM windows
                                       WHERE w + 120 <= (SELECT max(ts) FROM raw_pings) - 180) - 120"""
        ),
        "windows raw_pings raw_stops",
    ),
)
def live_vehicles_of_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The live view over what the stream has written: its newest days alone are opened."""
    base = shared_folder(spark, "stream-live")
    feeds.pings(spark, folder).write.json(f"{base}/in")
    schema = _worked_off(spark, base, "30 seconds")
    windows = recent_windows(spark, f"{base}/out", schema, views.LIVE_SECONDS)
    places = Relations(spark, folder).stop_locations()
    return eta_columns(views.live_vehicles(windows, places))


@query("csv_multipart", with_feeds("stop_times", "SELECT trip_id, departure_time, "
       "CAST(stop_sequence AS BIGINT) AS stop_sequence, shape_dist_traveled FROM raw_stop_times"))
def csv_multipart(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV feed in two parts, next to a file whose name only contains the feed's."""
    base = shared_folder(spark, "csv-multipart")
    rows = feeds.stop_times(spark, folder).selectExpr(
        # another column order, and one column the schema does not know
        "stop_sequence", "trip_id", "'x' as stop_headsign", "shape_dist_traveled", "departure_time"
    )
    early = F.col("stop_sequence") <= 3
    for name, part in (
        ("stop_times", rows.where(early)),
        ("stop_times1", rows.where(~early)),
        ("old_stop_times", rows),
    ):
        part.write.option("header", True).csv(f"{base}/{name}.csv")
    return read_csv_feed(spark, base, "stop_times", schemas.STOP_TIMES)


# Orders as a text feed in which some cells do not fit their types.
_DIRTY_ORDERS = {
    "order_id": "CAST(o_orderkey AS {text})",
    "customer_id": "CASE WHEN o_orderkey % 5 = 0 THEN concat('c-', CAST(o_custkey AS {text})) "
    "ELSE CAST(o_custkey AS {text}) END",
    "price": "CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN NULL "
    "ELSE CAST(o_totalprice AS {text}) END",
    "day": "CASE WHEN o_orderkey % 13 = 0 THEN '2024-13-45' "
    "ELSE substring(CAST(o_orderdate AS {text}), 1, 10) END",
    "priority": "o_orderpriority",
}
_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("day", T.DateType()),
        T.StructField("priority", T.StringType()),
    ]
)
_DIRTY_SQL = "SELECT {} FROM orders".format(
    ", ".join(f"{e.format(text='VARCHAR')} AS {c}" for c, e in _DIRTY_ORDERS.items())
)
_LOST_SQL = " UNION ALL ".join(
    f"SELECT order_id, '{c}' AS \"column\", {c} AS cell FROM dirty "
    f"WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL"
    for c, kind in (("customer_id", "BIGINT"), ("price", "DOUBLE"), ("day", "DATE"))
)


def _landed_orders(spark: SparkSession, folder: str) -> tuple[str, dict[str, int]]:
    base = shared_folder(spark, "lost-cells")
    table(spark, folder, "orders").selectExpr(
        *[f"{e.format(text='STRING')} AS {c}" for c, e in _DIRTY_ORDERS.items()]
    ).write.option("header", True).csv(f"{base}/orders.csv")
    text = read_csv_feed(spark, base, "orders")
    return base, land(text, _ORDERS, f"{base}/typed", f"{base}/lost", ["order_id"])


@query("lost_cells", f"WITH dirty AS ({_DIRTY_SQL}) {_LOST_SQL}")
def lost_cells_of_a_load(spark: SparkSession, folder: str) -> DataFrame:
    """What a load of dirty text could not read, cell by cell, from its ledger."""
    base, _ = _landed_orders(spark, folder)
    ledger = spark.read.schema("record string, column string, cell string").parquet(f"{base}/lost")
    return ledger.select(
        F.get_json_object("record", "$.order_id").alias("order_id"), "column", "cell"
    )


@query(
    "lost_cell_counts",
    f"""WITH dirty AS ({_DIRTY_SQL}), lost AS ({_LOST_SQL}),
        judged AS (SELECT unnest(['order_id', 'customer_id', 'price', 'day']) AS "column")
        SELECT j."column", count(l.cell) AS n_lost, (SELECT count(price) FROM dirty) -
          (SELECT count(*) FROM lost WHERE "column" = 'price') AS prices_kept
        FROM judged j LEFT JOIN lost l ON j."column" = l."column" GROUP BY j."column\"""",
)
def lost_cell_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lost cells per column as the write counted them, beside what it kept of a column."""
    base, counts = _landed_orders(spark, folder)
    kept = spark.read.schema(_ORDERS).parquet(f"{base}/typed").agg(
        F.count("price").alias("prices_kept")
    )
    return kept.select(
        F.expr(
            "inline(array("
            + ", ".join(f"named_struct('column', '{c}', 'n_lost', {n}L)" for c, n in counts.items())
            + "))"
        ),
        "prices_kept",
    )


def _documents(df: DataFrame, base: str, envelope: str | None = None) -> str:
    """Write records as JSON documents of bounded size, one per file.

    Documents are cut by position in the scan, so no key can make one too large.
    """
    chunk = F.floor(F.monotonically_increasing_id() / RECORDS_PER_DOCUMENT).alias("chunk")
    arrays = df.select(chunk, F.struct("*").alias("r")).groupBy("chunk").agg(
        F.collect_list("r").alias("records")
    )
    if envelope is None:
        body = F.to_json("records")
    else:
        body = F.to_json(
            F.struct(F.lit("somebody").alias("owner"), F.col("records").alias(envelope))
        )
    # one document per folder and file
    arrays.select("chunk", body.alias("value")).write.partitionBy("chunk").text(base)
    return f"{base}/chunk=*"


@query(
    "json_array_scan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
              o_orderkey % 2 AS direction_id FROM orders""",
)
def json_array_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Records from files that hold one JSON array each."""
    trips = table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey as string) as trip_id",
        "cast(o_custkey as string) as route_id",
        "o_orderkey % 2 as direction_id",
    )
    path = _documents(trips, shared_folder(spark, "json-array"))
    return read_json_array(spark, path, schemas.TRIPS).select(
        "trip_id", "route_id", "direction_id"
    )


@query(
    "enveloped_json",
    f"""SELECT dataPrevisao, tMax, CAST(classIntVento AS BIGINT) AS classIntVento, dataAtualiza
        FROM ({FEED_SQL['weather_data']})""",
)
def enveloped_json(spark: SparkSession, folder: str) -> DataFrame:
    """Records out of the ``data`` array of JSON documents."""
    weather = feeds.weather_data(spark, folder)
    path = _documents(weather, shared_folder(spark, "enveloped"), envelope="data")
    records = read_enveloped_json(spark, path, "data", schemas.WEATHER_DATA)
    return records.select("dataPrevisao", "tMax", "classIntVento", "dataAtualiza")


def _write_archives(df: DataFrame, base: str, member: str) -> None:
    """One zip archive per partition of ``df``, with its rows as a CSV member."""
    names = df.columns
    uri = arrow_uri(base) if "://" in base else f"file://{base}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root)
        path = f"{root}/part-{TaskContext.get().partitionId():05d}.zip"
        count = 0
        with store.open_output_stream(path) as raw, zipfile.ZipFile(
            raw, "w", zipfile.ZIP_DEFLATED
        ) as archive:
            with archive.open(member, "w", force_zip64=True) as entry:
                text = io.TextIOWrapper(entry, encoding="utf-8", newline="")
                text.write(",".join(names) + "\n")
                for batch in batches:
                    count += len(batch)
                    batch.to_csv(text, index=False, header=False, lineterminator="\n")
                text.flush()
        yield pd.DataFrame({"path": [path], "n": [count]})

    df.mapInPandas(write, "path string, n bigint").write.mode("overwrite").format("noop").save()


@query("zip_members", with_feeds("stop_times", "SELECT trip_id, departure_time, "
       "CAST(stop_sequence AS BIGINT) AS stop_sequence, shape_dist_traveled FROM raw_stop_times"))
def zip_members(spark: SparkSession, folder: str) -> DataFrame:
    """A member out of zipped bundles, as a typed table."""
    base = shared_folder(spark, "zip-members")
    _write_archives(
        feeds.stop_times(spark, folder).repartition("trip_id"), base, "stop_times.txt"
    )
    rows = zip_member_table(
        spark, f"{base}/*.zip", "stop_times.txt", schemas.STOP_TIMES.fieldNames()
    )
    return project_to(rows, schemas.STOP_TIMES)


@query(
    "landing_roundtrip",
    """SELECT event_id, user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS execution_date
       FROM events""",
)
def landing_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Dated landing folders, written for many days at once and read back."""
    base = shared_folder(spark, "landing")
    dated = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("day")
    )
    write_landing_partitioned(dated, base, "events", "day")
    return read_landing(spark, base, "events")


@query(
    "full_refresh",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
               strftime(o_orderdate, {TS}) AS o_orderdate, o_orderpriority FROM orders""",
)
def refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table replaced by a copy of another one with more columns."""
    target = shared_folder(spark, "full-refresh")
    orders = table(spark, folder, "orders")
    full_refresh(orders.select("o_orderkey"), target)
    full_refresh(orders, target)
    return spark.read.parquet(target)


@query(
    "incremental_load",
    with_feeds(
        "routes",
        """, first_load AS (SELECT id, long_name, line_id FROM raw_routes
                            WHERE ingested_at = TIMESTAMP '2024-01-01'),
        second_load AS (SELECT id, CASE WHEN line_id >= '2' THEN long_name
                                        ELSE replace(long_name, ' v1', ' v0') END AS long_name,
                               line_id
                        FROM raw_routes WHERE ingested_at = TIMESTAMP '2024-01-02')
        SELECT *, CAST(1 AS BIGINT) AS load FROM first_load
        UNION ALL
        SELECT *, 2 FROM (SELECT * FROM second_load EXCEPT SELECT * FROM first_load)""",
    ),
)
def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of a landed feed, and a repeat of the second that must add nothing."""
    target = shared_folder(spark, "incremental")
    routes = feeds.routes(spark, folder)
    first = routes.where("ingested_at = timestamp'2024-01-01'").select(
        "id", "long_name", "line_id", "municipalities"
    )
    second = routes.where("ingested_at = timestamp'2024-01-02'").selectExpr(
        "id",
        "if(line_id >= '2', long_name, replace(long_name, ' v1', ' v0')) as long_name",
        "line_id",
    )
    # rows that keep their name also keep their list of places
    second = second.join(first.select("id", "municipalities"), "id")

    def landed(df: DataFrame) -> DataFrame:
        path = shared_folder(spark, "landed")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    first, second = landed(first), landed(second)
    load_table(spark, first, target, now=datetime(2024, 1, 1))
    load_table(spark, second, target, now=datetime(2024, 1, 2))
    load_table(spark, second, target, now=datetime(2024, 1, 3))
    stored = spark.read.schema("id string, long_name string, line_id string, "
                               "ingested_at timestamp").parquet(target)
    return stored.select("id", "long_name", "line_id", F.day("ingested_at").alias("load"))


@query(
    "stop_locations",
    with_feeds(
        "stops",
        """SELECT stop_id, round(CAST(CAST(lat AS FLOAT) AS DOUBLE), 6) AS stop_lat,
                  round(CAST(CAST(lon AS FLOAT) AS DOUBLE), 6) AS stop_lon FROM raw_stops""",
    ),
)
def stop_places(spark: SparkSession, folder: str) -> DataFrame:
    return stop_locations(feeds.stops(spark, folder))
