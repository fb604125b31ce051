"""Cells lost to their types: counts of the load and the ledger beside it."""

import pytest
from pyspark.sql import types as T

from transitlake import schemas
from transitlake.plans import refresh
from transitlake.sources.files import read_csv_feed
from transitlake.sources.lost_cells import land, lost_cells, typed_with_counts
from workloads import QUERIES, SQL

from oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("column", T.DoubleType()),
        T.StructField("name", T.StringType()),
        T.StructField("absent", T.IntegerType()),
    ]
)
RAW = "id string, column string, name string, extra string"
ROWS = [
    ("1", "1.5", "a", "x"), ("x1", "n/a", "b", None), (None, None, None, None), ("  ", "", "c", "y"),
    ("99999999999999999999", "2", "d", "z"), ("x1", "n/a", "b", None),
]


@pytest.mark.parametrize("name", ["lost_cells", "lost_cell_counts"])
def test_against_sql(spark, name):
    assert compare(spark, connect(SMALL), QUERIES[name], SQL[name], SMALL) == []


def test_counts_and_ledger(spark, tmp_path):
    raw = spark.createDataFrame(ROWS, RAW)
    typed, ledger = f"{tmp_path}/typed", f"{tmp_path}/lost"
    counts = land(raw, SCHEMA, typed, ledger, now="2024-05-01 06:00:00")
    assert counts == {"id": 3, "column": 2}
    assert spark.read.parquet(typed).count() == len(ROWS)
    rows = spark.read.parquet(ledger).collect()
    assert sorted((r["column"], r.cell) for r in rows) == [
        ("column", "n/a"), ("column", "n/a"), ("id", "99999999999999999999"), ("id", "x1"), ("id", "x1"),
    ]
    assert {r.record for r in rows if r.cell == "n/a"} == {'{"id":"x1","column":"n/a","name":"b"}'}
    assert {str(r.ingested_at) for r in rows} == {"2024-05-01 06:00:00"}
    # another load adds to the ledger, a clean one leaves it alone
    land(raw, SCHEMA, typed, ledger)
    assert land(raw.limit(1), SCHEMA, typed, ledger) == {"id": 0, "column": 0}
    assert spark.read.parquet(ledger).count() == 10


def test_empty_and_text_only(spark, tmp_path):
    empty = spark.createDataFrame([], RAW)
    assert land(empty, SCHEMA, f"{tmp_path}/a", f"{tmp_path}/lost") == {"id": 0, "column": 0}
    words = T.StructType([T.StructField("name", T.StringType())])
    assert typed_with_counts(empty, words)[1] is None
    assert land(empty, words, f"{tmp_path}/b") == {}
    assert lost_cells(spark.createDataFrame(ROWS, RAW), words).count() == 0


def test_no_shuffle(spark):
    raw = spark.createDataFrame(ROWS, RAW)
    assert "Exchange" not in lost_cells(raw, SCHEMA)._jdf.queryExecution().toString()


def test_load_keeps_a_ledger(spark, tmp_path):
    folder, raw, ledger = (f"{tmp_path}/{x}" for x in ("feed", "raw", "ledger"))
    text = [("t1", "08:00:00", "1", "0.5"), ("t1", "08:10:00", "two", "0.9"), ("t2", "09:00:00", "1", "?")]
    names = schemas.STOP_TIMES.fieldNames()
    spark.createDataFrame(text, names).write.option("header", True).csv(f"{folder}/stop_times.csv")
    plain, lost = f"{tmp_path}/plain", {}
    modes = refresh.load_raw(spark, folder, raw, ["stop_times"], ledger_root=ledger, lost=lost)
    assert modes == refresh.load_raw(spark, folder, plain, ["stop_times"])
    assert lost == {"stop_times": {"stop_sequence": 1, "shape_dist_traveled": 1}}
    kept = [sorted(map(str, spark.read.parquet(f"{x}/stop_times").select(names).collect())) for x in (raw, plain)]
    assert kept[0] == kept[1] and len(kept[0]) == 3
    cells = spark.read.parquet(f"{ledger}/stop_times").collect()
    assert sorted(r.cell for r in cells) == ["?", "two"]
    assert read_csv_feed(spark, folder, "stop_times").count() == 3
