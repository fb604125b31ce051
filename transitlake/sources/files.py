"""Reading the CSV and JSON feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def feed_paths(folder: str, name: str, extension: str) -> str:
    """Glob for a feed file and its numbered parts, and nothing else.

    ``dates`` matches ``dates.csv`` and ``dates1.csv`` but not
    ``calendar_dates.csv``.
    """
    # up to six digits, each spelled out: "[0-9]*" would take any name after a digit
    parts = ",".join("[0-9]" * n for n in range(7))
    return f"{folder.rstrip('/')}/{name}{{{parts}}}.{extension}"


def project_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name; dirty values and missing columns give NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def read_csv_feed(
    spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """All parts of a CSV feed in one scan, matched to ``schema`` by header name.

    Files may hold more columns than the schema and in any order. The header
    names come from the first part; a part whose header differs is an error
    rather than silently shifted data.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .csv(feed_paths(folder, name, "csv"))
    )
    return raw if schema is None else project_to(raw, schema)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that each hold one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _any_value(schema: T.StructType):
    return F.coalesce(*[F.col(f"`{f.name}`").cast("string") for f in schema.fields]).isNotNull()


def read_enveloped_json(
    spark: SparkSession, path: str, field: str, schema: T.StructType
) -> DataFrame:
    """Records of the array under ``field`` of each JSON document.

    A document that is a plain array of records is taken as such (records that are
    all null aside).
    """
    envelope = T.StructType([T.StructField(field, T.ArrayType(schema))])
    documents = spark.read.schema(envelope).option("multiLine", True).json(path)
    enveloped = documents.select(F.inline(F.col(field)))
    # a document that is the plain array gives its records without the field
    return enveloped.unionByName(read_json_array(spark, path, schema).where(_any_value(schema)))


def stop_locations(stops: DataFrame) -> DataFrame:
    """``(stop_id, stop_lat, stop_lon)`` from the stops feed, whose coordinates are text."""
    return stops.select(
        "stop_id",
        F.col("lat").try_cast("float").alias("stop_lat"),
        F.col("lon").try_cast("float").alias("stop_lon"),
    )
