"""DataFrame operators, edge cases and brute-force comparisons."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitlake.operators import quality
from transitlake.operators.dedupe import endpoints_per_key, latest_per_key
from transitlake.operators.filters import recent_slice
from transitlake.operators import incremental
from transitlake.operators.incremental import load_table, new_or_changed
from transitlake.operators.joins import array_member_fold, array_member_left, unnest
from transitlake.operators.sequence import previous_value

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_latest_per_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "p"), (None, 1, "n"),
         ("c", 2, "k"), ("c", 2, "m")],
        "id string, v int, t string",
    )
    assert bag(latest_per_key(rows, ["id"], "v", ["t"])) == Counter(
        [("a", 3, "y"), ("b", None, "p"), (None, 1, "n"), ("c", 2, "m")]
    )


def test_endpoints_per_key(spark):
    rows = spark.createDataFrame(
        [("a", 2, "m"), ("a", 1, "f"), ("a", 9, "l"), ("b", 5, "only"), ("c", None, "n"),
         ("c", 1, "o")],
        "id string, s int, t string",
    )
    assert bag(endpoints_per_key(rows, ["id"], ["s"])) == Counter(
        [("a", 1, "f"), ("a", 9, "l"), ("b", 5, "only"), ("c", None, "n"), ("c", 1, "o")]
    )


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_previous_value_of_hot_keys_equals_lag(spark, hot):
    rng = random.Random(7)
    data = [
        (1 if rng.random() < hot else rng.choice([None, 1, 2, 3, 4, 5]), rng.randrange(200), i,
         None if rng.random() < 0.1 else rng.randrange(100))
        for i in range(600)
    ]
    rows = spark.createDataFrame(data, "k int, t int, i int, v int")
    plain = previous_value(rows, ["k"], ["t", "i"], "v", "p")
    # from one segment to a segment for each time, with empty ones between
    for segment in ("0", "t div 70", "t div 3", "t", F.when(F.col("t") > 150, 1).otherwise(0)):
        sliced = previous_value(rows, ["k"], ["t", "i"], "v", "p", segment)
        assert bag(sliced) == bag(plain)
    want, last = Counter(), {}
    for k, t, i, v in sorted(data, key=lambda r: (r[0] or 0, r[1], r[2])):
        want[(k, t, i, v, last.get(k))] += 1
        last[k] = v
    assert bag(plain) == want


def test_previous_value_without_order_or_rows(spark):
    rows = spark.createDataFrame([(1, None, 5), (1, 2, 6), (None, 1, 7), (None, 9, 8)], "k int, t int, v int")
    got = previous_value(rows, ["k"], ["t"], "v", "p", "t div 4")
    assert bag(got) == Counter([(1, None, 5, None), (1, 2, 6, 5), (None, 1, 7, None), (None, 9, 8, 7)])
    assert previous_value(rows.limit(0), ["k"], ["t"], "v", "p", "t div 4").collect() == []


def test_unnest_drops_empty(spark):
    rows = spark.createDataFrame(
        [(1, ["a", "b"]), (2, []), (3, None)], "i int, a array<string>"
    )
    assert bag(unnest(rows, "a", "e").select("i", "e")) == Counter([(1, "a"), (1, "b")])


def test_array_membership(spark):
    left = spark.createDataFrame(
        [(1, ["x", "y", "x"]), (2, ["q"]), (3, []), (4, None), (5, ["x", "q", None])],
        "i int, a array<string>",
    )
    right = spark.createDataFrame([("x", "X"), ("y", "Y"), ("x", "X2")], "id string, n string")
    rows = array_member_left(left, "a", right, "id", "i").select("i", "n")
    assert bag(rows) == Counter(
        [(1, "X"), (1, "X2"), (1, "Y"), (2, None), (3, None), (4, None), (5, "X"), (5, "X2")]
    )
    folded = array_member_fold(
        left, "a", right, "id", ["i"], [F.count("n").alias("c"), F.max("n").alias("m")]
    )
    assert bag(folded) == Counter(
        [(1, 3, "Y"), (2, 0, None), (3, 0, None), (4, 0, None), (5, 2, "X2")]
    )


def test_row_difference_null_safe_keeps_copies(spark):
    stored = spark.createDataFrame([(2, "x")], "a int, b string")
    incoming = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert bag(new_or_changed(incoming, stored)) == Counter({(1, None): 2})
    stored = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")
    assert new_or_changed(incoming, stored).count() == 0


def test_row_difference_nested_types(spark):
    schema = "i int, a array<string>, m map<string,int>, s struct<x:int,m:map<string,int>>"
    one = (1, ["p", None], {"k": 1, "l": 2}, (1, {"z": 1}))
    two = (2, None, None, None)
    changed = (1, ["p", None], {"k": 1, "l": 3}, (1, {"z": 1}))
    stored = spark.createDataFrame([one, two], schema)
    again = spark.createDataFrame([(1, ["p", None], {"l": 2, "k": 1}, (1, {"z": 1})), two], schema)
    assert new_or_changed(again, stored).count() == 0
    new = new_or_changed(spark.createDataFrame([one, changed, changed], schema), stored)
    assert new.columns == ["i", "a", "m", "s"]
    got = new.collect()
    assert len(got) == 2 and all(r.m == {"k": 1, "l": 3} and r.s.m == {"z": 1} for r in got)


def test_row_difference_floats_are_exact(spark):
    schema = "d double, f float, a array<double>"
    rows = [(0.1 + 0.2, 1.1, [0.3]), (-0.0, None, None), (float("nan"), 2.5, [float("nan")]),
            (5e-324, 3.4e38, []), (1e308, -1e-45, [1.0, None])]
    data = spark.createDataFrame(rows, schema)
    assert new_or_changed(data, data).count() == 0
    zero = spark.createDataFrame([(0.0, None, None)], schema)
    assert new_or_changed(zero, data).count() == 0
    near = spark.createDataFrame([(0.3, 1.1, [0.3])], schema)
    assert new_or_changed(near, data).count() == 1
    empty = data.where("false")
    back = new_or_changed(data, empty)
    assert back.schema == data.schema
    assert sorted(map(str, back.collect())) == sorted(
        str(r).replace("-0.0", "0.0") for r in data.collect()
    )


def test_row_difference_ignores_stamp_and_allows_new_columns(spark):
    stored = spark.createDataFrame([(1, "old")], "a int, ingested_at string")
    incoming = spark.createDataFrame([(1, None), (1, "n")], "a int, b string")
    assert bag(new_or_changed(incoming, stored)) == Counter([(1, "n")])


def test_copies_are_restored_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(incremental, "COPIES_PER_BLOCK", 7)
    incoming = spark.range(100).selectExpr("if(id < 40, 1, id) as a")
    stored = spark.createDataFrame([(99,)], "a bigint")
    got = bag(new_or_changed(incoming, stored))
    assert got == Counter({(1,): 40, **{(i,): 1 for i in range(40, 99)}})


values = st.one_of(st.none(), st.sampled_from(["a", "b"]))
rows_strategy = st.lists(st.tuples(values, st.one_of(st.none(), st.integers(0, 2))), max_size=12)


@few
@given(incoming=rows_strategy, stored=rows_strategy)
def test_row_difference_property(spark, incoming, stored):
    schema = "a string, b int"
    got = bag(
        new_or_changed(
            spark.createDataFrame(incoming, schema), spark.createDataFrame(stored, schema)
        )
    )
    assert got == Counter(r for r in incoming if r not in set(stored))


NOW = datetime(2024, 5, 1, 12)


def test_load_table_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    first = spark.createDataFrame(
        [(1, ["a", None]), (2, None), (2, None)], "i int, a array<string>"
    )
    assert load_table(spark, first, target, now=NOW) == "all"
    assert load_table(spark, first, target, now=NOW) == "diff"
    stored = spark.read.parquet(target)
    assert bag(stored.selectExpr("i", "cast(a as string)")) == Counter({(1, "[a]"): 1, (2, None): 2})
    more = first.union(spark.createDataFrame([(3, ["z"])], "i int, a array<string>"))
    load_table(spark, more, target, now=NOW + timedelta(days=1))
    spark.catalog.refreshByPath(target)
    assert spark.read.parquet(target).count() == 4


def test_load_named_table(spark):
    spark.sql("DROP TABLE IF EXISTS loaded")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "i int, t string")
    assert load_table(spark, rows, "loaded", now=NOW) == "all"
    assert load_table(spark, rows, "loaded", now=NOW) == "diff"
    assert spark.table("loaded").count() == 2
    more = spark.createDataFrame([(1, "b")], "i int, t string")
    load_table(spark, more, "loaded", NOW)
    assert spark.table("loaded").count() == 3
    spark.sql("DROP TABLE loaded")


def test_recent_slice_is_strict(spark):
    rows = spark.range(0, 200, 60).select(F.timestamp_seconds("id").alias("ts"), "id")
    assert [r.id for r in recent_slice(rows, "ts", 120).orderBy("id").collect()] == [120, 180]


def test_quality_checks(spark):
    rows = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", -1.0), (2, None, None), (None, "z", 0.0), (None, "a", 2.0)],
        "k int, t string, v double",
    )
    assert quality.not_null(rows, "k").count() == 2
    assert bag(quality.unique(rows, "k")) == Counter([(1, 2)])
    assert bag(quality.accepted_values(rows, "t", ["a", "b"])) == Counter([("z", 1)])
    assert quality.minimum_value(rows, "v", 0).count() == 1
    checks = [
        quality.Check("not_null", "k"),
        quality.Check("unique", "k"),
        quality.Check("accepted_values", "t", ("a", "b")),
        quality.Check("minimum_value", "v", 0),
        quality.Check("not_null", "t"),
    ]
    assert bag(quality.run_suite(rows, checks)) == Counter(
        [("not_null", "k", 2), ("unique", "k", 1), ("accepted_values", "t", 1),
         ("minimum_value", "v", 1), ("not_null", "t", 1)]
    )
    with pytest.raises(quality.QualityError, match="unique"):
        quality.require(rows, checks, "rows")
    assert quality.require(rows, [quality.Check("minimum_value", "v", -5)], "rows")
    with pytest.raises(ValueError):
        quality.Check("odd", "k").failing(rows)


def test_copies_are_restored_by_many_tasks(spark):
    rows = spark.range(3_000_000).select(F.lit("same").alias("t"))
    none = spark.createDataFrame([], "t string")
    fresh = new_or_changed(rows, none)
    tasks = fresh.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in tasks) == 3_000_000
    assert len(tasks) > 1
