"""Stored tables: a path of parquet files, or the name of a catalog table.

A target with a ``/`` in it is a path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def is_path(target: str) -> bool:
    return "/" in target


def exists(spark: SparkSession, target: str) -> bool:
    """Whether the target holds a finished write."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    # an interrupted first write leaves only names that start with _ or .
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return any(not name.startswith(("_", ".")) for name in names)


def location(spark: SparkSession, target: str) -> str:
    """The folder that holds the target's files."""
    if is_path(target):
        return target.rstrip("/")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {target}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


class Files:
    """Small files below a folder, by whatever file system holds it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._root = spark._jvm, root
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}" if name else self._root)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(path)]

    def size(self, folder: str = "") -> int:
        """Bytes of all files below a folder."""
        path = self._path(folder)
        return self._fs.getContentSummary(path).getLength() if self._fs.exists(path) else 0

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        """Write whole or not at all: the text is moved to its name when complete."""
        aside = self._path(f"{name}.tmp")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._fs.delete(self._path(name), False)
        if not self._fs.rename(aside, self._path(name)):
            raise OSError(f"could not write {name} below {self._root}")

    def move_data(self, source: str, target: str) -> None:
        """Move the data files of one folder into another; their names are unique."""
        for name in self.names(source):
            if not name.startswith(("_", ".")):
                if not self._fs.rename(self._path(f"{source}/{name}"), self._path(f"{target}/{name}")):
                    raise OSError(f"could not move {name} from {source} to {target}")

    def rename(self, source: str, target: str) -> None:
        """Move a file or folder to a name that is free."""
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target} below {self._root}")

    def delete(self, name: str) -> None:
        """Remove a file or folder below the root, if it is there."""
        if not name:
            raise ValueError("the root itself stays")
        self._fs.delete(self._path(name), True)


def read(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """Read the target; at a path, columns that older files lack come out NULL."""
    if not is_path(target):
        return spark.read.table(target)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(target)


def write(df: DataFrame, target: str, mode: str, partition_by: Sequence[str] = ()) -> None:
    """Write with the given mode.

    Partitioned output is rebalanced first: a small partition value is written
    by one task and a heavy one by several, so files are neither tiny nor the
    work of a single task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)


def full_refresh(source: DataFrame, target: str) -> None:
    """Replace the target by a copy of ``source``, schema included."""
    write(source, target, "overwrite")
