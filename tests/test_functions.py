"""Column functions against worked examples."""

import math

import random

import pytest
from pyspark.sql import functions as F

from transitlake.functions import gtfs_time as gt
from transitlake.functions.aggregates import ordered_texts, string_agg
from transitlake.functions.calendar import date_dimension, date_dimension_over
from transitlake.functions.clean import compact_arrays, decode, flag_gt, surrogate_key
from transitlake.functions.geo import eta_minutes, haversine_km, register_functions, speed_kmh


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_feed_times(spark):
    times = [
        "08:15:00", "24:00:00", "25:30:10", None, "48:00:00", "8:15:00", " 08:15:00 ",
        "100:00:01", "12:60:00", "12:00:60", "ab:cd:ef", "", "081500", "12:3:45", "-1:00:00",
        "12:00", "1:2:03:04",
    ]
    clock = column(spark, times, "string", gt.normalize("v"))
    assert clock == [
        "08:15:00", "00:00:00", "01:30:10", None, "00:00:00", "08:15:00", "08:15:00",
        "04:00:01", None, None, None, None, None, None, None, None, None,
    ]
    assert column(spark, times[:5], "string", gt.day_offset("v")) == [0, 1, 1, None, 2]
    assert column(spark, times[:3], "string", gt.to_seconds("v")) == [29700, 86400, 91810]


def test_time_type_when_enabled(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    got = column(spark, ["25:30:10", "x"], "string", gt.as_time("v").cast("string"))
    assert got == ["01:30:10", None]


def test_duration_counts_minute_boundaries_and_wraps(spark):
    rows = spark.createDataFrame(
        [(33260, 29730), (29730, 33260), (85800, 1200), (36000, 36000), (None, 5)], "a int, b int"
    )
    got = [r[0] for r in rows.select(gt.duration_minutes("a", "b")).collect()]
    # 09:14:20 to 08:15:30 crosses 59 boundaries backwards
    assert got == [1440 - 59, 59, 30, 0, None]


def test_delays(spark):
    rows = spark.createDataFrame([(300, 86100), (86100, 300), (None, 1)], "r int, p int")
    got = rows.select(
        gt.delay_seconds("r", "p"), gt.wrapped_delay_seconds("r", "p"),
        gt.as_interval("r - p").cast("string"),
    ).collect()
    assert [tuple(r)[:2] for r in got] == [(-85800, 600), (85800, -600), (None, None)]
    assert got[0][2] == "INTERVAL '-0 23:50:00' DAY TO SECOND" and got[2][2] is None


HAVERSINE = [
    ((0.0, 0.0, 1.0, 0.0), 111.19492664455873),
    ((38.7, -9.1, 38.71, -9.1), 1.1119492664455182),
    ((38.7223, -9.1393, 41.1579, -8.6291), 274.2955057331998),
    ((0.0, 0.0, 0.0, 180.0), 20015.086796020572),
    ((5.0, 5.0, 5.0, 5.0), 0.0),
    ((None, 0.0, 0.0, 0.0), None),
    ((0.0, 0.0, 0.0, None), None),
]


@pytest.mark.parametrize("points,km", HAVERSINE)
def test_haversine(spark, points, km):
    rows = spark.createDataFrame([points], "a double, b double, c double, d double")
    register_functions(spark)
    native, in_sql = rows.select(
        haversine_km(*"abcd"), F.expr("haversine_km(a, b, c, d)")
    ).first()
    if km is None:
        assert native is None and in_sql is None
    else:
        assert math.isclose(native, km, abs_tol=1e-6) and math.isclose(in_sql, km, abs_tol=1e-6)


def test_haversine_against_plain_python(spark):
    def plain(lat1, lon1, lat2, lon2):
        p1, p2 = math.radians(lat1), math.radians(lat2)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
            math.radians(lon2 - lon1) / 2
        ) ** 2
        return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))

    points = [
        (lat, lon, -lat / 2 + off, lon - off)
        for lat in range(-90, 91, 30)
        for lon in range(-180, 181, 45)
        for off in (0.001, 1, 77)
    ]
    rows = spark.createDataFrame(
        [tuple(map(float, p)) for p in points], "a double, b double, c double, d double"
    )
    for a, b, c, d, km in rows.select("*", haversine_km(*"abcd")).collect():
        assert math.isclose(km, plain(a, b, c, d), abs_tol=1e-6)


def test_speed_and_eta_guard_zero(spark):
    rows = spark.createDataFrame([(1.0, 120), (1.0, 0), (None, 3)], "km double, s int")
    assert [r[0] for r in rows.select(speed_kmh("km", "s")).collect()] == [30.0, None, None]
    rows = spark.createDataFrame([(5.0, 30.0), (5.0, 0.0)], "km double, v double")
    assert [r[0] for r in rows.select(eta_minutes("km", "v")).collect()] == [10.0, None]


def test_decode(spark):
    codes = [0, 1, 3, None, 9]
    assert column(spark, codes, "int", decode("v", {0: "none", 1: "it's", 3: "x\\y"})) == [
        "none", "it's", "x\\y", "Unknown", "Unknown",
    ]
    assert column(spark, ["a", "z", None], "string", decode("v", {"a": "A"}, "?")) == ["A", "?", "?"]


def test_flag_gt_is_never_null(spark):
    rows = spark.createDataFrame([(2, 1), (1, 2), (1, 1), (None, 1), (1, None)], "a int, b int")
    got = [r[0] for r in rows.select(flag_gt("a", "b")).collect()]
    assert got == [True, False, False, False, False]


def test_surrogate_key(spark):
    rows = spark.createDataFrame([("R1", "L1"), ("R1", None)], "a string, b string")
    assert [r[0] for r in rows.select(surrogate_key("a", "b")).collect()] == [
        "8873b6a8af59fa26964db5d36bff2069",
        "b946e96b25fa6bee2ed9d2dc985ead0f",
    ]


def test_compact_arrays(spark):
    rows = spark.createDataFrame(
        [(1, ["a", None, "b"], [None]), (2, None, [])], "i int, a array<string>, b array<int>"
    )
    got = {r.i: (r.a, r.b) for r in compact_arrays(rows).collect()}
    assert got == {1: (["a", "b"], []), 2: (None, [])}


def test_string_agg_skips_nulls(spark):
    rows = spark.createDataFrame(
        [(1, "b", 1), (1, None, 0), (1, "a", 2), (2, None, 1)], "k int, v string, o int"
    )
    grouped = rows.groupBy("k")
    plain = grouped.agg(string_agg(F.col("v")).alias("t"))
    assert {r.k: r.t for r in plain.collect()} == {1: "a;b", 2: None}
    ordered = grouped.agg(string_agg(F.col("v"), ",", F.col("o")).alias("t"))
    assert {r.k: r.t for r in ordered.collect()} == {1: "b,a", 2: None}


def test_date_dimension(spark):
    days = date_dimension(spark, "2023-01-01", "2030-12-31")
    assert len(days.columns) == 35
    rows = {str(r.date_day): r for r in days.collect()}
    assert len(rows) == 2921 and max(rows) == "2030-12-30"
    first = rows["2023-01-01"]
    assert (first.day_of_week, first.week_of_year, first.iso_week_of_year) == (1, 1, 52)
    assert str(first.iso_week_start_date) == "2022-12-26"
    leap = rows["2024-02-29"]
    assert (str(leap.week_start_date), leap.week_of_year, leap.iso_week_of_year) == (
        "2024-02-25", 8, 9,
    )
    assert str(leap.prior_year_date_day) == "2023-02-28"
    assert str(leap.prior_year_over_year_date_day) == "2023-03-02"
    last = rows["2024-12-31"]
    assert (last.week_of_year, last.iso_week_of_year, str(last.iso_week_start_date)) == (
        52, 1, "2024-12-30",
    )
    assert (last.month_name, last.day_of_week_name_short) == ("December", "Tue")
    assert (str(last.quarter_end_date), str(last.year_end_date)) == ("2024-12-31", "2024-12-31")
    assert all(r.week_of_year == int(r.date_day.strftime("%U")) for r in rows.values())
    assert all(r.iso_week_of_year == r.date_day.isocalendar()[1] for r in rows.values())
    assert date_dimension(spark, "2024-01-01", "2024-01-03", True).count() == 3


def test_date_dimension_over_data(spark):
    rows = spark.createDataFrame([("2024-02-27",), (None,), ("2024-03-01",)], "d string")
    rows = rows.select(F.to_date("d").alias("d"))
    assert date_dimension_over(rows, "d").count() == 4
    assert date_dimension_over(rows.where("d is null"), "d").count() == 0


def test_ordered_texts_are_put_together_from_pieces(spark):
    rng = random.Random(8)
    ids = [f"{i:04d}" for i in range(300)]
    data = [(rng.choice("aab") if i != "0007" else None, i, f"n{i}" if rng.random() < 0.9 else None) for i in ids]
    data += [("a", ids[3], "again"), ("c", "x", None), ("d", None, "nameless")]
    rows = spark.createDataFrame(data, "k string, id string, name string").repartition(5)
    want = {}
    for k in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == k), key=lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] or ""))
        want[k] = tuple(";".join(r[i] for r in own if r[i] is not None) or None for i in (1, 2))
    for piece in ("1", "substring(id, 1, 1)", "substring(id, 1, 3)", "id"):
        got = ordered_texts(rows, ["k"], "id", piece, ids="id", names="name").collect()
        assert {r.k: (r.ids, r["names"]) for r in got} == want
    assert ordered_texts(rows.limit(0), ["k"], "id", "id", ids="id").count() == 0


def test_a_hot_group_is_sorted_in_pieces(spark):
    hot = spark.range(0, 9_000, 1, 4).selectExpr("1 as k", "lpad(cast(id as string), 6, '0') as id")
    texts = ordered_texts(hot, ["k"], "id", "substring(id, 1, 4)", ids="id")
    plan = texts._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange") :].split("\n")[0]
    assert "_piece" in first
    assert texts.first().ids == ";".join(f"{i:06d}" for i in range(9_000))
