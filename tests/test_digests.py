"""Incremental loads that read only digests of their history."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from transitlake.operators import incremental
from transitlake.operators.digests import HIGH, LOW, DigestStore, digest_columns
from transitlake.operators.incremental import load_table
from transitlake.sources import tables

NOW = datetime(2024, 5, 1, 12)
ROWS = "i int, t string, d double"


def rows_of(spark, target):
    spark.catalog.refreshByPath(target)
    stored = spark.read.parquet(target)
    return Counter(tuple(r) for r in stored.drop("ingested_at").collect())


def digests(df):
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [tuple(r) for r in df.select(*digest_columns(df.columns, kinds)).collect()]


def test_digests_tell_rows_apart(spark):
    schema = "a string, b string, n array<string>, s struct<x:int,y:int>, m map<string,int>"
    rows = [
        ("p", None, None, None, None), (None, "p", None, None, None), ("p", "", None, None, None),
        (None, None, [], None, None), (None, None, [None], None, None), (None, None, ["null"], None, None),
        (None, None, ["a", "b"], None, None), (None, None, ["a, b"], None, None),
        (None, None, ["a", None], None, None), (None, None, [None, "a"], None, None),
        (None, None, None, (1, None), None), (None, None, None, (None, 1), None),
        (None, None, None, (None, None), None), (None, None, None, None, {}),
        (None, None, None, None, {"a": 1}), (None, None, None, None, {"a": None}), (None,) * 5,
        ("a", "b", None, None, None), ("b", "a", None, None, None), ("ab", "", None, None, None),
    ]
    found = digests(spark.createDataFrame(rows, schema))
    assert len(set(found)) == len(rows) and len({h for h, _ in found}) == len({l for _, l in found}) == len(rows)
    # microseconds within arrays count
    times = spark.sql("""SELECT array(timestamp'2024-01-01 00:00:00.000001') AS t
                         UNION ALL SELECT array(timestamp'2024-01-01 00:00:00.000002')""")
    assert len(set(digests(times))) == 2


def test_a_new_column_of_nulls_keeps_digests(spark):
    one = spark.createDataFrame([(1, "a"), (2, None)], "i int, t string")
    assert sorted(digests(one)) == sorted(digests(one.withColumn("later", F.lit(None).cast("string"))))


@pytest.mark.parametrize("named", [False, True])
def test_loads_append_what_is_new(spark, tmp_path, named):
    if named:
        spark.sql("DROP TABLE IF EXISTS fed")
    target = "fed" if named else str(tmp_path / "t")
    rng = random.Random(3)
    seen, want = set(), Counter()
    for day in range(4):
        rows = [(rng.randrange(40), rng.choice(["a", "b", None]), rng.choice([0.1, None])) for _ in range(60)]
        load_table(spark, spark.createDataFrame(rows, ROWS), target, NOW + timedelta(days=day), buckets=3)
        want.update(r for r in rows if r not in seen)
        seen.update(rows)
    got = tables.read(spark, target) if named else spark.read.parquet(target)
    assert Counter(tuple(r) for r in got.drop("ingested_at").collect()) == want
    store = DigestStore(spark, target)
    assert store.known().count() == len(seen) and store.layout["buckets"] == 3
    store.compact()
    assert store.known().count() == len(seen)
    assert load_table(spark, spark.createDataFrame(list(seen), ROWS), target, NOW + timedelta(days=9)) == "diff"
    assert tables.read(spark, target).count() == sum(want.values())
    if named:
        spark.sql("DROP TABLE fed")


@pytest.mark.parametrize("buckets", [3, 5])
def test_history_is_read_by_its_digests_and_not_shuffled(spark, tmp_path, buckets):
    """With fewer and with more buckets than shuffle partitions."""
    target = str(tmp_path / "t")
    data = spark.range(500).selectExpr("CAST(id AS INT) AS i", "repeat('x', 50) AS t", "id / 7 AS d")
    load_table(spark, data, target, NOW, buckets=buckets)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = DigestStore(spark, target)
        kinds = {f.name: f.dataType for f in data.schema.fields}
        incoming = data.select(*digest_columns(data.columns, kinds)).groupBy(HIGH, LOW).count()
        fresh = store.new(incoming)
        assert fresh.count() == 0
        text = fresh._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(line for line in text.splitlines() if "FileScan" in line and "row_digests" in line)
    assert "ReadSchema: struct<_digest_high:bigint,_digest_low:bigint>" in scan and "Bucketed: true" in scan
    # what is shuffled is the load's own digests; nothing stands between scan and join
    assert "Exchange" not in text[text.index("isnotnull(_digest_high") :]
    stored = text[text.rindex("Sort [") :]
    assert "row_digests" in stored and "Exchange" not in stored


def test_keys_bring_back_a_former_value(spark, tmp_path):
    target = str(tmp_path / "t")
    for day, value in enumerate(["A", "A", "B", "A", "A", None, "A"]):
        rows = spark.createDataFrame([(1, value), (2, "same"), (None, value)], "k int, v string")
        load_table(spark, rows, target, NOW + timedelta(days=day), keys=["k"], buckets=2)
    spark.catalog.refreshByPath(target)
    got = spark.read.parquet(target).where("k = 1").orderBy("ingested_at").collect()
    assert [r.v for r in got] == ["A", "B", "A", None, "A"]
    assert spark.read.parquet(target).where("k = 2").count() == 1
    assert spark.read.parquet(target).where("k IS NULL").count() == 5


def test_columns_may_come_go_and_change(spark, tmp_path):
    target = str(tmp_path / "t")
    load_table(spark, spark.createDataFrame([(1, "a")], "i int, t string"), target, NOW)
    wider = "i int, t string, u string"
    load_table(spark, spark.createDataFrame([(1, "a", None), (1, "a", "new")], wider), target, NOW)
    spark.catalog.refreshByPath(target)
    assert spark.read.schema(wider).parquet(target).count() == 2
    assert DigestStore(spark, target).layout["generation"] == "generation-0"
    # without u both stored rows equal the incoming one
    load_table(spark, spark.createDataFrame([(1, "a")], "i int, t string"), target, NOW)
    spark.catalog.refreshByPath(target)
    assert spark.read.schema(wider).parquet(target).count() == 2
    assert DigestStore(spark, target).layout["generation"] != "generation-0"


def test_a_table_from_before_the_store_is_read_once(spark, tmp_path):
    target = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", 0.5), (1, "a", 0.5)], ROWS)
    old.withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp")).write.parquet(target)
    assert load_table(spark, old.union(spark.createDataFrame([(2, None, None)], ROWS)), target, NOW) == "diff"
    assert rows_of(spark, target) == Counter({(1, "a", 0.5): 2, (2, None, None): 1})


@pytest.mark.parametrize("broken", ["before the rows", "after the rows", "after the digests"])
def test_a_load_that_broke_off_is_settled(spark, tmp_path, monkeypatch, broken):
    target = str(tmp_path / "t")
    load_table(spark, spark.createDataFrame([(1, "a", 1.0)], ROWS), target, NOW)
    more = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (2, "b", 2.0), (3, "c", 3.0)], ROWS)

    class Stop(Exception):
        pass

    def stop(*_):
        raise Stop

    with monkeypatch.context() as patch:
        if broken == "before the rows":
            patch.setattr(incremental.tables, "write", stop)
        elif broken == "after the rows":
            patch.setattr(DigestStore, "take_pending", stop)
        else:
            patch.setattr(DigestStore, "settled", stop)
        with pytest.raises(Stop):
            load_table(spark, more, target, NOW + timedelta(days=1))
    load_table(spark, more, target, NOW + timedelta(days=2))
    load_table(spark, more, target, NOW + timedelta(days=3))
    assert rows_of(spark, target) == Counter({(1, "a", 1.0): 1, (2, "b", 2.0): 2, (3, "c", 3.0): 1})
    assert DigestStore(spark, target).pending_stamp() is None


def test_a_new_row_with_many_copies_is_loaded_whole(spark, tmp_path):
    target = str(tmp_path / "t")
    same = spark.range(0, 50_000, 1, 6).selectExpr("7 AS i", "'same' AS t")
    load_table(spark, same, target, NOW)
    load_table(spark, same, target, NOW)
    assert rows_of(spark, target) == Counter({(7, "same"): 50_000})


def test_empty_loads(spark, tmp_path):
    target = str(tmp_path / "t")
    none = spark.createDataFrame([], ROWS)
    load_table(spark, none, target, NOW)
    load_table(spark, spark.createDataFrame([(1, None, None)], ROWS), target, NOW)
    load_table(spark, none, target, NOW)
    assert rows_of(spark, target) == Counter({(1, None, None): 1})
