"""Staging, marts, key figures and the whole refresh on small feeds."""

import json
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from transitlake import schemas
from transitlake.functions import gtfs_time as gt
from transitlake.operators.dedupe import endpoints_per_key, latest_per_key
from transitlake.operators.quality import Check, QualityError
from transitlake.operators.sequence import previous_value
from transitlake.sources.versions import Versions, published
from transitlake.plans import kpis, marts, refresh, staging, suites
from transitlake.sources.tables import full_refresh

V1, V2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
NOW = datetime(2024, 6, 1)

STOP_ROWS = [
    ("T1", "08:00:00", 1, 0.0), ("T1", "08:10:00", 2, 4000.0), ("T1", "08:30:00", 3, 10000.0),
    ("T2", "23:50:00", 1, 0.0), ("T2", "24:20:00", 2, 9000.0),
    ("T3", "09:00:00", 1, 0.0),
    ("T4", "10:00:00", 1, 0.0), ("T4", "10:00:00", 2, 500.0),
]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def feeds(spark):
    stamped = schemas.with_stamp
    return {
        "stop_times": frame(
            spark, [(*r, V1) for r in STOP_ROWS], stamped(schemas.STOP_TIMES)
        ),
        "calendar_dates": frame(
            spark,
            [(20240102, 1, 1, 0, 1, "S1", V1), (20240103, 1, 1, 0, 1, "S1", V1),
             (20240102, 2, 1, 0, 9, "S2", V1), (20240102, 1, 1, 0, 1, "S1", V2)],
            stamped(schemas.CALENDAR_DATES),
        ),
        "periods": frame(spark, [(1, "Verão", V1)], stamped(schemas.PERIODS)),
        "trips": frame(
            spark,
            [("T1", "R1", "P", "S1", "H", 0, V1), ("T1", "R1", "P2", "S1", "H", 0, V2),
             ("T2", "R1", "P", "S2", "H", 1, V1), ("T2", "R2", "P", "S2", "H", 1, V2),
             ("T3", "R1", "P", "S9", "H", 0, V1), ("T4", "R9", "P", "S1", "H", 1, V1)],
            stamped(schemas.TRIPS),
        ),
        "stops": frame(
            spark,
            [("1", "s1", "Old", "m1", "A", "reg", "ACTIVE", ["P"], ["R1"], "1", "2", V1),
             ("1", "s1", "New", "m1", "A", "reg", "ACTIVE", ["P"], ["R1", "R2"], "1", "2", V2),
             ("2", "s2", "Two", "m1", "A", "reg", "ACTIVE", ["P"], ["R1"], "1", "2", V1),
             ("3", "s3", "None", "m2", "B", "reg", "VOIDED", ["P"], None, "1", "2", V1),
             ("4", "s4", "Empty", "m2", "B", "reg", "SEASONAL", ["P"], [], "1", "2", V1)],
            stamped(schemas.STOPS),
        ),
        "lines": frame(
            spark,
            [("L1", "Line one", ["R1"], ["P"], V1), ("L1", "Line 1", ["R1", "R2"], ["P"], V2)],
            stamped(schemas.LINES),
        ),
        "routes": frame(
            spark,
            [("R1", "Route 1 old", "L1", ["m1"], V1),
             ("R1", "Route 1", "L1", ["m2", "m1", "m2", None, "zz"], V2),
             ("R2", "Route 2", "L1", None, V1), ("R3", "Route 3", "LX", [], V1)],
            stamped(schemas.ROUTES),
        ),
        "municipalities": frame(
            spark, [("m1", "A", V1), ("m2", "B", V1)], stamped(schemas.MUNICIPALITIES)
        ),
        "weather_data": frame(
            spark,
            [("2024-01-02", "15.5", "x", 1, 0, 1, "2024-01-01T10", V1),
             ("2024-01-02", "16.5", "7", 4, 3, 30, "2024-01-01T20", V1),
             ("2024-01-03", None, None, 0, 4, 31, "2024-01-01T20", V1),
             ("2024-01-04", "1", "1", None, None, None, "2024-01-01T20", V1)],
            stamped(schemas.WEATHER_DATA),
        ),
        "historical_stop_times": frame(
            spark,
            [("T1", datetime(2024, 1, 2, 8, 1, 59)), ("T1", datetime(2024, 1, 2, 8, 35, 10)),
             ("T2", datetime(2024, 1, 2, 23, 50, 30)), ("T2", datetime(2024, 1, 3, 0, 20, 1)),
             ("T8", datetime(2024, 1, 5, 1, 0, 0))],
            schemas.HISTORICAL_STOP_TIMES,
        ),
    }


@pytest.fixture
def stage(spark, feeds):
    return refresh.staging_relations(spark, feeds.__getitem__)


@pytest.fixture
def routes_dim(stage):
    return marts.dim_routes(stage["routes"], stage["lines"], stage["stops"], NOW)


@pytest.fixture
def fact(stage, routes_dim):
    return marts.fact_trips(
        stage["stop_times"], stage["trips"], routes_dim, stage["calendar_dates"]
    )


def test_stop_times(stage):
    rows = {r.trip_id: r for r in stage["stop_times"].collect()}
    short = {
        k: (r.scheduled_start_time, r.scheduled_end_time, r.number_of_stops, r.stop_sequence,
            r.shape_dist_traveled)
        for k, r in rows.items()
    }
    assert short == {
        "T1": ("08:00:00", "08:30:00", 3, 3, 10000.0),
        "T2": ("23:50:00", "00:20:00", 2, 2, 9000.0),
        "T3": (None, "09:00:00", 1, 1, 0.0),
        "T4": ("10:00:00", "10:00:00", 2, 2, 500.0),
    }


def test_stop_times_dedupe_and_nulls(spark):
    rows = frame(
        spark,
        [("a", "08:00:00", 1, 0.0), ("a", "08:00:00", 1, 0.0), ("a", "bad", 2, 9.0),
         ("b", "07:00:00", None, 1.0), ("b", "06:00:00", 1, 2.0)],
        schemas.STOP_TIMES,
    )
    plain = {r.trip_id: r for r in staging.stop_times(rows).collect()}
    assert plain["a"].number_of_stops == 3 and plain["a"].scheduled_end_time is None
    assert plain["a"].scheduled_start_time == "08:00:00"
    assert plain["b"].scheduled_start_time == "07:00:00" and plain["b"].stop_sequence == 1
    deduped = {r.trip_id: r for r in staging.stop_times(rows, dedupe=True).collect()}
    assert deduped["a"].number_of_stops == 2


def test_fused_stop_times_equal_window_form(spark):
    rng = random.Random(11)
    data = []
    for trip in range(120):
        hour = rng.randrange(4, 27)
        for seq in rng.sample(range(1, 40), rng.randrange(1, 9)):
            data.append((f"T{trip}", f"{hour:02d}:{seq:02d}:{rng.randrange(60):02d}", seq,
                         float(rng.randrange(9999))))
    raw = frame(spark, data, schemas.STOP_TIMES)
    ends = endpoints_per_key(raw, ["trip_id"], ["stop_sequence"])
    lagged = previous_value(ends, ["trip_id"], ["stop_sequence"], "departure_time", "start")
    last = latest_per_key(lagged, ["trip_id"], "stop_sequence")
    counts = raw.groupBy("trip_id").agg(F.count("*").alias("n"))
    window_form = last.join(counts, "trip_id").select(
        "trip_id", gt.normalize("start"), gt.normalize("departure_time"), "stop_sequence",
        "shape_dist_traveled", "n",
    )
    fused = staging.stop_times(raw).select(
        "trip_id", "scheduled_start_time", "scheduled_end_time", "stop_sequence",
        "shape_dist_traveled", "number_of_stops",
    )
    assert Counter(map(tuple, fused.collect())) == Counter(map(tuple, window_form.collect()))


def test_real_stop_times(spark, feeds):
    raw = feeds["historical_stop_times"]
    rows = {r.trip_id: r for r in staging.real_stop_times(raw).collect()}
    t2 = rows["T2"]
    assert (t2.trip_date, t2.real_start_time, t2.real_end_time) == (
        date(2024, 1, 2), "23:50:00", "00:20:00",
    )
    by_day = staging.real_stop_times(raw, by_day=True)
    assert by_day.where("trip_id = 'T2'").count() == 2
    local = staging.real_stop_times(raw, feed_tz="Asia/Tokyo").where("trip_id = 'T1'").first()
    assert local.real_start_time == "17:01:00"


def test_calendar_dates(stage):
    names = {(str(r.date), r.service_id): r.period_name for r in stage["calendar_dates"].collect()}
    assert names[("2024-01-02", "S1")] == "Verão" and names[("2024-01-02", "S2")] == "Outros"


def test_routes(spark, feeds, stage):
    rows = {r.route_id: tuple(r)[1:] for r in stage["routes"].collect()}
    assert rows == {
        "R1": ("Route 1", "L1", "A;B", "m1;m2"),
        "R2": ("Route 2", "L1", None, None),
        "R3": ("Route 3", "LX", None, None),
    }
    quick = staging.routes(feeds["routes"], feeds["municipalities"], dedupe_first=True)
    assert {r.route_id: tuple(r)[1:] for r in quick.collect()} == rows
    twice = feeds["municipalities"].union(
        feeds["municipalities"].withColumn("ingested_at", F.lit(V2))
    )
    doubled = staging.routes(feeds["routes"], twice).where("route_id = 'R1'").first()
    assert doubled.list_municipality_ids == "m1;m1;m2;m2"
    single = staging.routes(feeds["routes"], twice, dedupe_municipalities=True)
    assert single.where("route_id = 'R1'").first().list_municipality_ids == "m1;m2"


def test_weather(stage):
    rows = {str(r.date): tuple(r)[1:] for r in stage["weather_data"].collect()}
    assert rows == {
        "2024-01-02": (16.5, 7.0, "Very strong", "Strong", "Rain and snow"),
        "2024-01-03": (None, None, "Unknown", "Unknown", "Unknown"),
        "2024-01-04": (1.0, 1.0, "Unknown", "Unknown", "Unknown"),
    }


def test_dim_routes(routes_dim):
    rows = {r.route_id: r for r in routes_dim.collect()}
    assert set(rows) == {"R1", "R2"}
    assert rows["R1"].sk_routes == "8873b6a8af59fa26964db5d36bff2069"
    assert (rows["R1"].stops_ids, rows["R1"].stops_names) == ("s1;s2", "New;Two")
    assert (rows["R2"].stops_ids, rows["R2"].line_name) == ("s1", "Line 1")


def test_dim_date_keeps_differing_services(spark, stage):
    dim = marts.dim_date(stage["dates"], stage["calendar_dates"], NOW)
    assert dim.count() == 2921 + 1
    assert dim.where("date_day = '2024-01-02'").count() == 2
    assert len(dim.columns) == 40


def test_fact_trips(fact):
    rows = Counter(
        (r.trip_id, str(r.planned_date), r.sk_routes and r.sk_routes[:4], r.direction,
         r.average_speed_kmh)
        for r in fact.collect()
    )
    r1, r2 = "8873", fact.where("trip_id = 'T2' and sk_routes not like '8873%'").first().sk_routes[:4]
    assert rows == Counter(
        [("T1", "2024-01-02", r1, 0, 20.0), ("T1", "2024-01-03", r1, 0, 20.0),
         ("T2", "2024-01-02", r1, 1, 18.0), ("T2", "2024-01-02", r2, 1, 18.0),
         ("T3", "None", r1, 0, None),
         ("T4", "2024-01-02", None, 1, None), ("T4", "2024-01-03", None, 1, None)]
    )


def test_fact_trips_equals_plain_distinct(stage, routes_dim, fact):
    """The reshaped plan against the straightforward chain ending in DISTINCT."""
    days = stage["trips"].join(
        stage["calendar_dates"].select("service_id", "date"), "service_id"
    ).select("trip_id", "date").distinct()
    plain = (
        stage["stop_times"]
        .join(stage["trips"], "trip_id", "left")
        .join(routes_dim.select("route_id", "sk_routes"), "route_id", "left")
        .join(days, "trip_id", "left")
        .select("trip_id", "scheduled_start_time", "scheduled_end_time", "date",
                "shape_dist_traveled", "number_of_stops", "sk_routes", "direction_id")
        .distinct()
    )
    ours = fact.select(
        "trip_id", "planned_start_time", "planned_end_time", "planned_date",
        "total_distance_traveled", "number_of_stops", "sk_routes", "direction",
    )
    assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, plain.collect()))


def test_fact_trips_options(stage, feeds, routes_dim):
    latest = marts.fact_trips(
        stage["stop_times"], feeds["trips"], routes_dim, stage["calendar_dates"],
        latest_only=["ingested_at"],
    )
    assert latest.where("trip_id = 'T2'").count() == 1
    none = marts.fact_trips(
        stage["stop_times"], stage["trips"], routes_dim, stage["calendar_dates"],
        exception_types=[2],
    )
    assert none.where("planned_date is not null").count() == 0


def test_dim_historical_trips(stage, fact):
    dim = marts.dim_historical_trips(stage["real_stop_times"], fact, NOW)
    rows = {r.trip_id: r for r in dim.collect()}
    t1, t2, t8 = rows["T1"], rows["T2"], rows["T8"]
    assert (t1.departed_late, t1.arrived_late, t1.accumulated_delay) == (True, True, 360)
    assert (t2.departed_late, t2.arrived_late, t2.accumulated_delay) == (False, False, 0)
    assert (t8.departed_late, t8.arrived_late, t8.accumulated_delay) == (False, False, None)


def test_kpis(stage, routes_dim, fact):
    days = marts.dim_date(stage["dates"], stage["calendar_dates"], NOW)
    by_line = {
        r.line_id: r for r in kpis.trip_kpis(fact, routes_dim, days, ["line_id"]).collect()
    }
    line = by_line["L1"]
    # T2 has two routes of the line on one day: two fact rows, but one trip, 9 km and 30 minutes
    assert (line.number_of_trips, line.km_travelled, line.travel_minutes) == (4, 29.0, 90)
    by_day = kpis.trip_kpis(fact, routes_dim, days, ["planned_date", "day_type"])
    assert by_day.where("planned_date = '2024-01-02'").first().number_of_trips == 3
    rolled = kpis.trip_kpis(fact, routes_dim, days, ["line_id", "direction"], "rollup")
    # the grand total, and the total of the trips without a line
    assert rolled.where("line_id is null and direction is null").count() == 2
    with pytest.raises(ValueError):
        kpis.trip_kpis(fact, routes_dim, days, ["line_id"], "other")


def test_route_questions(stage):
    assert {r[0] for r in kpis.routes_at_stop(stage["stops"], "s1").collect()} == {"R1", "R2"}
    assert kpis.routes_at_stop(stage["stops"], "s").count() == 0
    assert {r[0] for r in kpis.routes_in_municipality(stage["routes"], "m2").collect()} == {"R1"}
    assert kpis.stop_route_pairs(stage["stops"]).count() == 3
    assert kpis.route_municipality_pairs(stage["routes"]).count() == 2


def test_declared_checks_are_complete():
    checks = [c for s in (suites.STAGING, suites.MARTS) for cs in s.values() for c in cs]
    kinds = Counter(c.kind for c in checks)
    assert kinds == {"not_null": 64, "unique": 7, "accepted_values": 2, "minimum_value": 3}


def write_feed_files(folder, extra_trip=False):
    folder.mkdir()
    trips = "trip_id,route_id,pattern_id,service_id,shape_id,direction_id\nT1,R1,P,S1,H,0\n"
    if extra_trip:
        trips += "T2,R1,P,S1,H,1\n"
    (folder / "trips.csv").write_text(trips)
    (folder / "stop_times.csv").write_text(
        "trip_id,arrival_time,departure_time,stop_sequence,shape_dist_traveled\n"
        "T1,x,08:00:00,1,0\nT1,x,08:30:00,2,10000\n"
    )
    (folder / "stop_times1.csv").write_text(
        "trip_id,arrival_time,departure_time,stop_sequence,shape_dist_traveled\n"
        "T2,x,23:50:00,1,0\nT2,x,24:20:00,2,9000\n"
    )
    (folder / "calendar_dates.csv").write_text(
        "service_id,date,day_type,exception_type,holiday,period\nS1,20240102,1,1,0,1\n"
    )
    (folder / "periods.csv").write_text("period_id,period_name\n1,Verão\n")
    for name, records in {
        "stops": [{"id": "1", "stop_id": "s1", "name": "One", "municipality_id": "m1",
                   "municipality_name": "A", "region_name": "R", "operational_status": "ACTIVE",
                   "patterns": ["P", None], "routes": ["R1"], "lat": "38.7", "lon": "-9.1"}],
        "lines": [{"id": "L1", "long_name": "Line", "routes": ["R1"], "patterns": ["P"]}],
        "routes": [{"id": "R1", "long_name": "Route", "line_id": "L1", "municipalities": ["m1"]}],
        "municipalities": [{"id": "m1", "name": "A"}],
        "weather_data": [{"dataPrevisao": "2024-01-02", "tMax": "16.1", "tMin": "9",
                          "classIntVento": 1, "classIntPrecipita": 0, "idTipoTempo": 2,
                          "dataAtualiza": "2024-01-01T10"}],
    }.items():
        (folder / f"{name}.json").write_text(json.dumps(records))


def test_refresh_end_to_end(spark, tmp_path, monkeypatch):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    observed = frame(
        spark, [("T1", datetime(2024, 1, 2, 8, 2))], schemas.HISTORICAL_STOP_TIMES
    )
    full_refresh(observed, f"{raw}/historical_stop_times")

    write_feed_files(tmp_path / "day1")
    # the schedule of T2 has no trip yet, so the fact fails its checks
    with pytest.raises(QualityError, match="fact_trips"):
        refresh.run(spark, str(tmp_path / "day1"), raw, out, now=V1)
    assert Versions(spark, out).current() is None

    write_feed_files(tmp_path / "day2", extra_trip=True)
    done = refresh.run(spark, str(tmp_path / "day2"), raw, out, now=V2)
    assert set(done.load_modes.values()) == {"diff"}
    assert not any(done.failures.values())
    assert spark.read.parquet(f"{raw}/trips").count() == 2
    assert spark.read.parquet(f"{raw}/stop_times").count() == 4
    fact = published(spark, out, "fact_trips")
    assert fact.where("planned_date = date'2024-01-02'").count() == 2
    late = published(spark, out, "dim_historical_trips").first()
    assert late.departed_late and not late.arrived_late
    assert spark.table("staging_stops").count() == 1
    assert published(spark, out, "staging/stop_times").count() == 2

    # the same from views only, without stopping at failures
    plain = refresh.build_marts(
        spark, lambda n: refresh.read_raw(spark, raw, n), str(tmp_path / "plain"), strict=False
    )
    assert not any(plain.failures.values())
    columns = fact.columns
    again = published(spark, str(tmp_path / "plain"), "fact_trips").select(*columns)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, fact.collect()))

    # a version that fails its last checks leaves the good one in use, and readable
    impossible = [Check("accepted_values", "trip_id", ("none",))]
    monkeypatch.setitem(suites.MARTS, "dim_historical_trips", impossible)
    with pytest.raises(QualityError, match="dim_historical_trips"):
        refresh.build_marts(spark, lambda n: refresh.read_raw(spark, raw, n), out)
    assert published(spark, out, "fact_trips").count() == fact.count() == 2
    assert Versions(spark, out).current()["version"] == done.version


def test_job_takes_observed_stop_times(spark, tmp_path):
    from transitlake.plans import job

    source, raw, out = (str(tmp_path / n) for n in ("observed", "raw", "out"))
    observed = frame(spark, [("T1", datetime(2024, 1, 2, 8, 2))], schemas.HISTORICAL_STOP_TIMES)
    observed.write.parquet(source)
    write_feed_files(tmp_path / "day", extra_trip=True)
    settings = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in settings}
    try:
        done = job.main([str(tmp_path / "day"), raw, out, "--observed", source])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert done.version and published(spark, out, "dim_historical_trips").count() == 1
