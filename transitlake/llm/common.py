"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.session import shared_folder
from transitlake.sources.tables import Files

# Shuffle files of a query go as soon as it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back.

    The reread relation has no lineage, so a lost executor costs a file read and
    never a second run of what came before.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shelf:
    """Relations that a job stores, each until the job drops it.

    The shuffle files behind a relation go as soon as it is written, so that of a chain of
    relations no more lies on disk than what is still read.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, df: DataFrame, label: str, *parts: str) -> DataFrame:
        """Store a relation, in folders by the columns ``parts``."""
        conf, path = self.spark.conf, shared_folder(self.spark, label)
        before = conf.get(TIDY, None)
        conf.set(TIDY, "true")
        try:
            df.write.option("compression", "zstd").partitionBy(*parts).parquet(path)
        finally:
            conf.unset(TIDY) if before is None else conf.set(TIDY, before)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_part(self, label: str, part: str) -> None:
        """Delete one folder (``column=value``) of a relation; the others are still read."""
        Files(self.spark, self.paths[label]).delete(part)

    def drop(self, *labels: str) -> None:
        """Delete relations that nothing reads any more."""
        for label in labels:
            folder, _, name = self.paths.pop(label).rpartition("/")
            Files(self.spark, folder).delete(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(name: str = "text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 2_000_000
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches of about ``most`` bytes of text, with the texts.

    A slice holds at least one row; a longer text is a slice of its own.
    """
    for batch in batches:
        col = batch.column(column)
        texts = col.to_pylist()
        start, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= most or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
