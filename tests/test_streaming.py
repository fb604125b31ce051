"""The ping stream: closed windows, late rows, restarts."""

import json
import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from transitlake.plans import views
from transitlake.streaming.pings import (
    PING,
    read_pings,
    run,
    vehicle_windows,
    with_event_time,
    work_off,
    write_windows,
)
from transitlake.streaming import sink
from transitlake.streaming.late import late_rows
from transitlake.streaming.panes import state_on_disk, windows_of_panes

START = int(datetime(2025, 1, 1, 10, tzinfo=timezone.utc).timestamp())


def ping(second, vehicle="v1", trip="t1", lat=38.7, lon=-9.1, **more):
    return {
        "id": vehicle, "trip_id": trip, "timestamp": START + second, "lat": lat, "lon": lon,
        "current_status": "IN_TRANSIT_TO", "route_id": "r", "stop_id": "s", **more,
    }


def write_files(folder, batches, first=0):
    os.makedirs(folder, exist_ok=True)
    for i, batch in enumerate(batches, start=first):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            f.writelines(json.dumps(p) + "\n" for p in batch)
        # the file source takes files in order of modification time
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def stream_to(spark, base, max_files=1):
    windows = vehicle_windows(read_pings(spark, f"{base}/in", max_files))
    query = write_windows(windows, f"{base}/out", f"{base}/checkpoint", trigger=None)
    assert run(query, 120)
    return sink.read_windows(spark, f"{base}/out", windows.schema)


def test_append_emits_only_closed_windows(spark, tmp_path):
    pings = [ping(30 * i, lat=38.7 + 0.001 * i) for i in range(24)]
    write_files(tmp_path / "in", [pings[i : i + 4] for i in range(0, 24, 4)])
    out = stream_to(spark, tmp_path)
    batch = vehicle_windows(spark.read.schema(PING).json(str(tmp_path / "in")))
    assert batch.count() == 27
    assert out.count() == 17
    last = out.agg(F.unix_seconds(F.max("window.end"))).first()[0]
    assert last == START + 8 * 60 + 30
    closed = batch.where(F.unix_seconds("window.end") <= last)
    assert sorted(map(str, out.collect())) == sorted(map(str, closed.collect()))


def test_late_row_is_dropped_and_single_ping_has_no_speed(spark, tmp_path):
    # lateness is judged by the watermark the batch before last has set
    write_files(
        tmp_path / "in",
        [[ping(0)], [ping(900)], [ping(910)], [ping(10, lat=50.0)], [ping(2000)], [ping(3000)]],
    )
    rows = stream_to(spark, tmp_path).collect()
    early = [r for r in rows if r.window.start.timestamp() < START + 600]
    assert early and all(r.last_lat < 40 for r in early)
    assert all(r.time_delta == 0 and r.average_speed is None for r in early)


def test_restart_continues_from_checkpoint(spark, tmp_path):
    pings = [ping(30 * i) for i in range(24)]
    write_files(tmp_path / "in", [pings[:12]])
    first = stream_to(spark, tmp_path).count()
    write_files(tmp_path / "in", [pings[12:]], first=1)
    assert 0 < first < stream_to(spark, tmp_path).count() == 17


def test_first_and_last_follow_event_time(spark):
    rows = [ping(40, lat=3.0), ping(0, lat=1.0), ping(20, lat=2.0, current_status="ZZ")]
    pings = spark.createDataFrame([tuple(r.get(n) for n in PING.names) for r in rows], PING)
    window = vehicle_windows(pings).where(F.unix_seconds("window.start") == START).first()
    assert (window.first_lat, window.last_lat, window.time_delta) == (1.0, 3.0, 40)
    assert window.current_status == "ZZ"
    assert with_event_time(pings).schema["timestamp"].dataType.simpleString() == "timestamp"


@pytest.fixture
def windows(spark):
    rows = [
        ping(0, lat=38.70), ping(60, lat=38.71), ping(300, lat=38.72), ping(360, lat=38.73),
        ping(0, vehicle="v2", stop_id="nowhere"),
    ]
    pings = spark.createDataFrame([tuple(r.get(n) for n in PING.names) for r in rows], PING)
    return vehicle_windows(pings)


@pytest.fixture
def stops(spark):
    return spark.createDataFrame([("s", 38.75, -9.1)], "stop_id string, stop_lat float, stop_lon float")


def test_live_view(windows, stops):
    rows = views.live_vehicles(windows, stops).collect()
    assert {r.id for r in rows} == {"v1"}
    assert all(r.last_timestamp.timestamp() > START + 240 for r in rows)
    moving = [r for r in rows if r.time_delta == 60]
    # 0.02 degrees to go at 0.01 degrees a minute
    assert moving and all(abs(r.stop_eta - 2.0) < 0.01 for r in moving)


def test_latest_view(windows, stops):
    rows = {r.id: r for r in views.latest_vehicles(windows, stops).collect()}
    assert set(rows) == {"v1", "v2"}
    assert rows["v2"].stop_lat is None and rows["v2"].stop_eta is None
    assert rows["v1"].window.end.timestamp() == START + 480


def test_stream_joins_stops(spark, tmp_path, stops):
    write_files(tmp_path / "in", [[ping(0)], [ping(60)], [ping(900)], [ping(1800)]])
    stream = vehicle_windows(read_pings(spark, f"{tmp_path}/in"))
    located = views.with_next_stop(stream, stops)
    query = write_windows(located, f"{tmp_path}/out", f"{tmp_path}/cp", trigger=None)
    assert run(query, 120)
    stored = sink.read_windows(spark, f"{tmp_path}/out", located.schema)
    assert stored.where("stop_lat is not null").count() > 0


def test_bounded_run_stops(spark, tmp_path):
    write_files(tmp_path / "in", [[ping(0)]])
    windows = vehicle_windows(read_pings(spark, f"{tmp_path}/in"))
    query = write_windows(windows, f"{tmp_path}/out", f"{tmp_path}/cp", trigger="1 second")
    assert run(query, 3) is False
    assert not query.isActive


def test_windows_per_ping_follow_the_slide(spark):
    pings = spark.createDataFrame([tuple(ping(7).get(n) for n in PING.names)], PING)
    assert vehicle_windows(pings).count() == 4
    assert vehicle_windows(pings, slide="10 seconds").count() == 12


def test_job_works_off_what_is_there(spark, tmp_path):
    from transitlake.streaming import job

    write_files(tmp_path / "in", [[ping(0)], [ping(900)], [ping(1800)]])
    job.main([f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp", "0"])
    assert spark.read.parquet(f"{tmp_path}/out").count() > 0


def test_backlog_of_overlapping_files_keeps_every_window(spark, tmp_path):
    rows = [
        (str(v), f"{v}-0", 1_704_067_200 + 30 * k) for v in range(3) for k in range(120)
    ]
    pings = spark.createDataFrame(rows, "id string, trip_id string, timestamp long")
    # every file holds times of the whole hour
    pings.repartition(6).write.json(f"{tmp_path}/in")
    windows = vehicle_windows(read_pings(spark, f"{tmp_path}/in"))
    work_off(write_windows(windows, f"{tmp_path}/out", f"{tmp_path}/ck", trigger=None))
    batch = vehicle_windows(spark.read.schema(PING).json(f"{tmp_path}/in"))
    last = 1_704_067_200 + 30 * 119
    closed = batch.where(f"unix_timestamp(window.end) <= {last - 180}").count()
    assert spark.read.parquet(f"{tmp_path}/out").count() == closed > 0


def many_batches(count, late_every):
    """One ping a minute; every so often one from long before comes with it."""
    return [
        [ping(60 * i)] + ([ping(60 * i - 3600, lat=50.0)] if i % late_every == 0 and i > 60 else [])
        for i in range(count)
    ]


def test_late_rows_of_all_batches_are_counted(spark, tmp_path):
    batches = many_batches(108, 5)
    write_files(tmp_path / "in", batches)
    windows = vehicle_windows(read_pings(spark, f"{tmp_path}/in", 1))
    query = write_windows(windows, f"{tmp_path}/out", f"{tmp_path}/cp", trigger=None)
    with pytest.raises(RuntimeError, match="dropped as late"):
        work_off(query)
    ledger = late_rows(spark)
    # more than a query's own reports reach back
    assert ledger.batches(query) > 100 >= len(query.recentProgress)
    want = sum(len(b) == 2 for b in batches)
    assert ledger.total(query) == want == 9
    rows = ledger.table(spark).where(f"run_id = '{query.runId}'").collect()
    assert len(rows) == want and all(r["rows"] == 1 for r in rows)


def test_a_batch_run_again_leaves_no_row_twice(spark, tmp_path, monkeypatch):
    write_files(tmp_path / "in", [[ping(30 * i)] for i in range(24)])
    real, wrote = sink._write, []

    def fail_after_writing(df, out):
        real(df, out)
        wrote.append(1)
        if len(wrote) == 12:
            raise OSError("lost between write and commit")

    windows = vehicle_windows(read_pings(spark, f"{tmp_path}/in", 1))
    with monkeypatch.context() as patch:
        patch.setattr(sink, "_write", fail_after_writing)
        query = write_windows(windows, f"{tmp_path}/out", f"{tmp_path}/checkpoint", trigger=None)
        with pytest.raises(Exception, match="lost between"):
            query.awaitTermination(120)
    before = sink.read_windows(spark, f"{tmp_path}/out", windows.schema).count()
    out = stream_to(spark, tmp_path)
    rows = out.select("id", "trip_id", "window").collect()
    assert 0 < before < len(rows) == len(set(rows)) == 17


def test_days_are_compacted_and_read_once(spark, tmp_path):
    second_day = 15 * 3600
    write_files(tmp_path / "in", [[ping(60 * i)] for i in range(8)] + [[ping(second_day + 60 * i)] for i in range(8)])
    out, folder = stream_to(spark, tmp_path), f"{tmp_path}/out"
    schema, want = out.schema, sorted(map(str, out.collect()))
    days = sink.stored_batches(spark, folder)
    assert len(days) == 2 and all(len(b) > 1 for b in days.values())
    first, last = sorted(days)
    assert sink.compact(spark, folder, schema, first) == len(days[first])
    assert len(sink.stored_batches(spark, folder)[first]) == 1
    # the newest batch may be run again and stays
    sink.compact(spark, folder, schema, last)
    left = sink.stored_batches(spark, folder)[last]
    assert len(left) == 2 and left[0] < 0 and left[1] == days[last][-1]
    assert sorted(map(str, sink.read_windows(spark, folder, schema).collect())) == want
    # folders that a compaction could not remove are passed over
    os.makedirs(f"{folder}/day={first}/batch={days[first][0]}")
    assert sorted(map(str, sink.read_windows(spark, folder, schema).collect())) == want
    assert sink.compact(spark, folder, schema, first) == 0
    assert len(sink.stored_batches(spark, folder)[first]) == 1
    recent = sink.recent_windows(spark, folder, schema, 120)
    assert recent.inputFiles() and recent.where("last_timestamp > timestamp'2025-01-02'").count() > 0
    far = sink.read_windows(spark, folder, schema, last)
    assert all(f"day={last}" in name for name in far.inputFiles())


def test_an_empty_sink_has_no_windows(spark, tmp_path):
    write_files(tmp_path / "in", [[ping(0)]])
    out = stream_to(spark, tmp_path)
    assert out.count() == 0 and "window" in out.columns
    assert sink.recent_windows(spark, f"{tmp_path}/out", out.schema, 120).count() == 0


def test_pings_are_combined_in_panes_before_they_are_copied(spark):
    rows = spark.range(0, 12_000, 1, 4).selectExpr(
        "cast(id % 2 as string) as id", "'t' as trip_id", f"{START} + id % 600 as timestamp",
        "cast(1 as float) as lat", "cast(2 as float) as lon", "'x' as current_status",
        "'r' as route_id", "'s' as stop_id",
    )
    windows = vehicle_windows(rows, slide="10 seconds")
    plan = windows._jdf.queryExecution().executedPlan().toString()
    # the copies for overlapping windows are made above the first shuffle only
    assert "Expand" not in plan[plan.rindex("Exchange") :] and "Expand" in plan
    windows.write.format("noop").mode("overwrite").save()
    from test_plans import shuffled_records

    panes = 2 * 60
    # one row per vehicle, pane and window start of a task goes through each shuffle
    assert shuffled_records(spark, windows.select("id", "window")) <= panes * 12 * 4
    want = windows.groupBy("id").count().collect()
    assert all(r["count"] == 60 + 11 for r in want)


def test_a_day_of_a_batch_is_one_file(spark, tmp_path):
    # four tasks hold pings of each of three days
    write_files(
        tmp_path / "in",
        [[ping(86_400 * day + 40 * i, f"v{i}") for day in range(3) for i in range(40)]],
    )
    stream_to(spark, tmp_path)
    written = sorted((tmp_path / "out").glob("day=*/batch=*/*.parquet"))
    days = {str(p.parent) for p in written}
    assert len(days) == 3 and len(written) == 3


def test_panes_are_not_merged_into_few_tasks_before_they_are_copied(spark):
    rows = spark.range(0, 20_000, 1, 4).selectExpr(
        "cast(id % 400 as string) as id", "'t' as trip_id", f"{START} + id as timestamp",
        "cast(1 as float) as lat", "cast(2 as float) as lon", "'x' as current_status",
        "'r' as route_id", "'s' as stop_id",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        windows = vehicle_windows(rows, slide="10 seconds")
        windows.write.format("noop").mode("overwrite").save()
        plan = windows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # the shuffle below the copies keeps its number of tasks
    below = plan[plan.index("Expand") :]
    first = below[below.index("Exchange") :].splitlines()[0]
    assert "REPARTITION_BY_NUM" in first and ", 40)" in first


def mixed_pings(seed=7):
    """Pings in order of time: gaps, busy minutes, an hour's end, unnamed vehicles and trips."""
    draw = random.Random(seed)
    second, pings = 3_400, []
    for _ in range(260):
        second += draw.choice([0, 1, 7, 12, 31, 64, 119, 121, 400])
        pings.append(
            ping(
                second, draw.choice(["v1", "v2", None]), draw.choice(["t1", None]),
                lat=38 + draw.random(), lon=-9 - draw.random(),
                current_status=draw.choice(["A", "B", None]), stop_id=draw.choice(["s", None]),
            )
        )
    return pings


@pytest.mark.parametrize(
    "window",
    [{"slide": "10 seconds"}, {"slide": "30 seconds"}, {"length": "50 seconds", "slide": "20 seconds"}],
)
def test_windows_of_closed_panes_equal_the_batch_form(spark, tmp_path, window):
    pings = mixed_pings()
    write_files(tmp_path / "in", [pings[i : i + 24] for i in range(0, len(pings), 24)])
    frame = vehicle_windows(read_pings(spark, f"{tmp_path}/in", 1), **window)
    query = write_windows(frame, f"{tmp_path}/out", f"{tmp_path}/ck", trigger=None)
    assert run(query, 120)
    # Spark's state holds panes, and no windows
    assert all(len(p.stateOperators) <= 1 for p in query.recentProgress)
    out = sink.read_windows(spark, f"{tmp_path}/out", frame.schema)
    batch = vehicle_windows(spark.read.schema(PING).json(f"{tmp_path}/in"), **window)
    last = pings[-1]["timestamp"] - 180
    closed = batch.where(F.unix_seconds("window.end") <= last)
    assert closed.count() > 300
    assert sorted(map(str, out.collect())) == sorted(map(str, closed.collect()))


def test_busy_hours_and_vehicles_are_dealt_to_many_tasks(spark):
    # one vehicle of a thousand panes and many vehicles, all in two hours
    fix = "named_struct('ts', timestamp_seconds({0}), 'lat', 38f, 'lon', -9f)"
    start = "if(id < 700, id * 10, 3000 + id % 60 * 10)"
    panes = spark.range(0, 4_000, 1, 4).selectExpr(
        f"{start} as _start", "if(id < 700, 'busy', cast(id as string)) as id", "'t' as trip_id",
        "'x' as current_status", "'r' as route_id", "'s' as stop_id",
        f"{fix.format(start)} as _first", f"{fix.format(start + ' + 5')} as _last",
    )
    windows = windows_of_panes(panes, 120, 10, 0, 100_000, 8)
    plan = windows._jdf.queryExecution().executedPlan().toString()
    # panes are shuffled once and windows not at all
    assert plan.count("Exchange") == 1 and plan.index("Window") < plan.index("Exchange")
    made = windows.groupBy(F.spark_partition_id()).count().collect()
    assert len(made) == 8
    # starts before 1970 end after it: windows that end later than 0 seconds
    assert sum(r["count"] for r in made) == 700 + 11 + 3_300 * 12
    assert max(r["count"] for r in made) < 2 * sum(r["count"] for r in made) / 8
    busy = windows.where("id = 'busy'").selectExpr("unix_seconds(window.start) as w", "*")
    assert busy.select("w").distinct().count() == busy.count() == 711
    assert busy.where(
        "unix_seconds(first_timestamp) <> greatest(w, 0)"
        " or unix_seconds(last_timestamp) <> least(w + 110, 6990) + 5"
    ).isEmpty()


def test_a_checkpoint_without_panes_is_continued(spark, tmp_path):
    pings = [ping(30 * i) for i in range(24)]
    write_files(tmp_path / "in", [pings[:12]])
    windows = vehicle_windows(read_pings(spark, f"{tmp_path}/in", 1))
    # a derived frame runs as it is planned, windows in the state
    query = write_windows(windows.select("*"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", trigger=None)
    assert run(query, 120)
    assert not (tmp_path / "checkpoint" / "panes").exists()
    write_files(tmp_path / "in", [pings[12:]], first=1)
    assert stream_to(spark, tmp_path).count() == 17


def test_state_settings_are_those_of_the_query_alone(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    session = spark.newSession()
    before = session.conf.get(key)
    with state_on_disk(session):
        assert "RocksDB" in session.conf.get(key)
    assert session.conf.get(key) == before and key not in session.conf.getAll
    # a choice of the session's own holds
    session.conf.set(key, before)
    with state_on_disk(session):
        assert session.conf.get(key) == before
    assert session.conf.get(key) == before
