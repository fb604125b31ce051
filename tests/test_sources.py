"""Readers and writers of feeds."""

import json
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake import schemas
from transitlake.sources import archives, files, landing, tables
from transitlake.sources.tables import full_refresh


def test_csv_parts_by_header_name(spark, tmp_path):
    header = "stop_id,departure_time,trip_id,stop_sequence,shape_dist_traveled\n"
    (tmp_path / "stop_times.csv").write_text(header + "s,08:00:00,T1,1,0\ns,08:10:00,T1,2,4.5\n")
    (tmp_path / "stop_times1.csv").write_text(header + "s,25:00:00,T2,x,9\n")
    (tmp_path / "my_stop_times.csv").write_text(header + "s,01:00:00,NO,1,9\n")
    (tmp_path / "stop_times_old.csv").write_text(header + "s,01:00:00,NO,1,9\n")
    rows = files.read_csv_feed(spark, str(tmp_path), "stop_times", schemas.STOP_TIMES)
    assert rows.schema == schemas.STOP_TIMES
    assert Counter(map(tuple, rows.collect())) == Counter(
        [("T1", "08:00:00", 1, 0.0), ("T1", "08:10:00", 2, 4.5), ("T2", "25:00:00", None, 9.0)]
    )


def test_csv_part_with_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "periods.csv").write_text("period_id,period_name\n1,a\n")
    (tmp_path / "periods1.csv").write_text("period_name,period_id\nb,2\n")
    with pytest.raises(Exception):
        files.read_csv_feed(spark, str(tmp_path), "periods", schemas.PERIODS).collect()


def test_dates_feed_does_not_match_calendar_dates(spark, tmp_path):
    (tmp_path / "dates.csv").write_text("date\n20240101\n")
    (tmp_path / "calendar_dates.csv").write_text("date\n20250101\n20250102\n")
    assert files.read_csv_feed(spark, str(tmp_path), "dates").count() == 1


def test_json_array_and_envelope(spark, tmp_path):
    records = [{"id": "1", "name": "A", "extra": 5}, {"id": "2"}]
    (tmp_path / "municipalities.json").write_text(json.dumps(records, indent=1))
    rows = files.read_json_array(
        spark, str(tmp_path / "municipalities.json"), schemas.MUNICIPALITIES
    )
    assert Counter(map(tuple, rows.collect())) == Counter([("1", "A"), ("2", None)])
    (tmp_path / "w.json").write_text(json.dumps({"owner": "x", "data": records}))
    rows = files.read_enveloped_json(spark, str(tmp_path / "w.json"), "data", schemas.MUNICIPALITIES)
    assert rows.count() == 2


def test_stop_locations(spark):
    rows = spark.createDataFrame([("s", "38.7", "-9.1"), ("t", "?", None)], "stop_id string, lat string, lon string")
    got = {r.stop_id: (r.stop_lat, r.stop_lon) for r in files.stop_locations(rows).collect()}
    assert got["t"] == (None, None) and abs(got["s"][0] - 38.7) < 1e-5


@pytest.fixture
def bundles(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("trips.txt", "trip_id,route_id\nT1,R1\nT2,R2\n")
        z.writestr("periods.txt", "period_id,period_name\n")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        # another order, one more column, a quoted comma, Windows line ends
        z.writestr("trips.txt", '﻿route_id,note,trip_id\r\nR3,"x, y",T3\r\n')
    (tmp_path / "c.zip").write_bytes(b"not an archive")
    return str(tmp_path / "*.zip")


def test_zip_members(spark, bundles):
    rows = archives.extract_zip_members(spark, bundles, ["trips.txt", "periods.txt"])
    seen = Counter((r.archive.rsplit("/")[-1], r.member, r.status) for r in rows.collect())
    assert seen == Counter(
        {("a.zip", "trips.txt", "ok"): 2, ("a.zip", "periods.txt", "empty"): 1,
         ("b.zip", "trips.txt", "ok"): 1, ("b.zip", "periods.txt", "missing"): 1,
         ("c.zip", "trips.txt", "bad"): 1, ("c.zip", "periods.txt", "bad"): 1}
    )
    table = archives.zip_member_table(spark, bundles, "trips.txt", ["trip_id", "route_id", "z"])
    assert Counter(map(tuple, table.collect())) == Counter(
        [("T1", "R1", None), ("T2", "R2", None), ("T3", "R3", None)]
    )
    everything = archives.zip_member_table(spark, bundles, "trips.txt")
    assert {(r.trip_id, r.note) for r in everything.collect()} == {
        ("T1", None), ("T2", None), ("T3", "x, y"),
    }


def test_zip_member_with_quoted_line_breaks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        text = '"trip,id",note\r\nT1,"two\nlines, ""quoted"""\r\n\r\nT2,\r\nT3\r\n'
        z.writestr("trips.txt", text)
    table = archives.zip_member_table(spark, str(tmp_path / "*.zip"), "trips.txt")
    assert table.columns == ["trip,id", "note"]
    assert set(map(tuple, table.collect())) == {
        ("T1", 'two\nlines, "quoted"'), ("T2", None), ("T3", None),
    }


def test_store_names():
    assert archives.arrow_uri("s3a://b/x.zip") == "s3://b/x.zip"
    for same in ("s3://b/x.zip", "gs://b/x.zip", "hdfs://n/x.zip"):
        assert archives.arrow_uri(same) == same


def test_zip_member_read_in_batches(spark, tmp_path):
    lines = "".join(f"{i},r\n" for i in range(120_001))
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("trips.txt", "trip_id,route_id\n" + lines)
    rows = archives.extract_zip_members(spark, str(tmp_path / "a.zip"), ["trips.txt"])
    n, first, last, distinct = rows.agg(
        F.count("*"), F.min("record_no"), F.max("record_no"), F.count_distinct("record_no")
    ).first()
    assert (n, first, last, distinct) == (120_001, 1, 120_001, 120_001)


def test_land_zip_member_and_read_feed(spark, bundles, tmp_path):
    out = str(tmp_path / "landing")
    archives.land_zip_member(spark, bundles, "trips.txt", out, "trips", max_records_per_file=1)
    rows = files.read_csv_feed(spark, out, "trips", schemas.TRIPS)
    assert {(r.trip_id, r.route_id, r.service_id) for r in rows.collect()} == {
        ("T1", "R1", None), ("T2", "R2", None), ("T3", "R3", None),
    }


def test_land_bundle(spark, bundles, tmp_path):
    out = str(tmp_path / "landing")
    found = archives.land_bundle(spark, bundles, out)
    assert found[("trips.txt", "ok")] == 2 and found[("periods.txt", "empty")] == 1
    assert found[("shapes.txt", "missing")] == 2 and found[("shapes.txt", "bad")] == 1
    assert files.read_csv_feed(spark, out, "trips", schemas.TRIPS).count() == 3
    assert files.read_csv_feed(spark, out, "periods", schemas.PERIODS).count() == 0
    assert not (tmp_path / "landing" / "shapes.csv").exists()


def test_landing_by_day(spark, tmp_path):
    root = str(tmp_path)
    landing.write_landing(spark.range(3), root, "f", "2024-01-01")
    landing.write_landing(spark.range(5), root, "f", "2024-01-02")
    landing.write_landing(spark.range(4), root, "f", "2024-01-02")
    assert landing.read_landing(spark, root, "f").count() == 7
    day = landing.read_landing(spark, root, "f", "2024-01-02")
    assert day.count() == 4
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(execution_date" in plan
    dated = spark.range(6).selectExpr("id", "date_add(date'2024-02-01', cast(id % 2 as int)) as d")
    landing.write_landing_partitioned(dated, root, "g", "d")
    assert landing.read_landing(spark, root, "g", "2024-02-02").count() == 3


def test_full_refresh(spark, tmp_path):
    target = str(tmp_path / "t")
    full_refresh(spark.range(3), target)
    full_refresh(spark.range(5).selectExpr("id", "'x' as t"), target)
    spark.catalog.refreshByPath(target)
    assert spark.read.parquet(target).columns == ["id", "t"]
    assert spark.read.parquet(target).count() == 5


def test_partitioned_write_and_existence(spark, tmp_path):
    target = str(tmp_path / "t")
    assert not tables.exists(spark, target)
    (tmp_path / "t" / "_temporary").mkdir(parents=True)
    assert not tables.exists(spark, target)
    rows = spark.range(100).selectExpr("id", "id % 3 as part")
    tables.write(rows, target, "overwrite", ["part"])
    assert tables.exists(spark, target)
    assert tables.read(spark, target, rows.schema).where("part = 1").count() == 33


def test_archive_readers_need_no_package_on_executors(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "f").write_bytes(cloudpickle.dumps(archives._read_members))
    code = "import pickle; f = pickle.load(open('f', 'rb')); print(list(f(iter([]))))"
    # isolated mode: neither this folder nor PYTHONPATH is searched
    done = subprocess.run(
        [sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.stdout.strip() == "[]", done.stderr


def test_parts_are_numbered_and_nothing_else(spark, tmp_path):
    for name in ("stops", "stops1", "stops12", "stops1_backup", "bus_stops"):
        (tmp_path / f"{name}.csv").write_text(f"stop_id\n{name}\n")
    found = {r.stop_id for r in files.read_csv_feed(spark, str(tmp_path), "stops").collect()}
    assert found == {"stops", "stops1", "stops12"}


def test_envelope_or_plain_array(spark, tmp_path):
    schema = T.StructType.fromDDL("day string, t string")
    (tmp_path / "a.json").write_text('{"data": [{"day": "d1", "t": "1"}, {"day": "d2", "t": "2"}]}')
    (tmp_path / "b.json").write_text('[{"day": "d3", "t": "3"}]')
    for name, days in (("a", {"d1", "d2"}), ("b", {"d3"})):
        got = files.read_enveloped_json(spark, str(tmp_path / f"{name}.json"), "data", schema)
        assert {r.day for r in got.collect()} == days


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from transitlake.session import ensure_checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context
    )
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session)
